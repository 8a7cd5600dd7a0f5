"""Streams (batch equality for closed windows, state merge, parsing, T9) and file sources."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tickwise.operators import bars, model, samples
from tickwise.sources import files, tables
from tickwise.sources.tables import tag_events
from tickwise.streaming import live, merge, publish, sinks, sources, timers


def _staged_events(spark, tmp_dir, parts=5):
    """Write the events table as time-ordered files (one micro-batch each)."""
    ev = tables.table(spark, SF_SMALL, "events")
    lo, hi = ev.agg(F.min("ts"), F.max("ts")).first()
    step = (hi - lo) / parts
    folder = f"{tmp_dir}/events"
    for i in range(parts):
        a, b = lo + step * i, lo + step * (i + 1)
        sl = ev.where((F.col("ts") >= a) & ((F.col("ts") < b) if i < parts - 1 else F.lit(True)))
        sl.coalesce(1).write.mode("overwrite").parquet(f"{folder}/p{i}")
    return folder, ev.schema


def _stream(spark, folder, schema):
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", True).parquet(folder))


def _same_row(a, b):
    for c in ("Open", "High", "Low", "Close", "Volume", "Score"):
        assert (a[c] is None and b[c] is None) or a[c] == pytest.approx(b[c])
    assert a.news_count == b.news_count


def _closed(batch, max_ts, delay_min=10, timeout_min=None):
    cut = max_ts - dt.timedelta(minutes=delay_min)
    return {r.Timestamp_Rounded: r for r in batch
            if r.Timestamp_Rounded + dt.timedelta(minutes=1) <= cut}


def test_window_and_state_merge_equal_batch(spark, tmp_dir):
    folder, schema = _staged_events(spark, tmp_dir)
    tagged = tag_events(_stream(spark, folder, schema))
    win = sinks.run_to_parquet(merge.window_merge(tagged), "t-win",
                               checkpoint=f"{tmp_dir}/ck1", out=f"{tmp_dir}/o1").collect()
    batch_df = bars.minute_features_tagged(tables.tagged_ticks(spark, SF_SMALL))
    batch = {r.Timestamp_Rounded: r for r in batch_df.collect()}
    max_ts = tables.tagged_ticks(spark, SF_SMALL).agg(F.max("ts")).first()[0]
    got = {r.Timestamp_Rounded: r for r in win}
    closed = _closed(batch.values(), max_ts)
    # every closed minute was emitted exactly once and equals the batch row
    assert set(closed) <= set(got)
    for k, r in got.items():
        _same_row(r, batch[k])
    st = sinks.run_to_parquet(merge.state_merge(tag_events(_stream(spark, folder, schema))), "t-state",
                              checkpoint=f"{tmp_dir}/ck2", out=f"{tmp_dir}/o2").collect()
    for r in st:
        _same_row(r, batch[r.Timestamp_Rounded])
    # every minute whose timeout the watermark has passed came out
    last = {}
    for r in tables.tagged_ticks(spark, SF_SMALL).collect():
        m = r.ts.replace(second=0, microsecond=0)
        last[m] = max(last.get(m, r.ts), r.ts)
    due = {m for m, t in last.items() if t + dt.timedelta(minutes=40) < max_ts}
    assert due <= {r.Timestamp_Rounded for r in st}


def test_streams_read_a_table_folder_and_flush(spark, tmp_dir):
    import __spark_entry__ as E
    spark.read.parquet(f"{SF_SMALL}/events.parquet").repartition(4).write.parquet(f"{tmp_dir}/events.parquet")
    want = {r.Timestamp_Rounded for r in bars.minute_features_tagged(
        tables.tagged_ticks(spark, SF_SMALL)).collect()}
    for name in ("stream_minute_features", "stream_state_merge"):
        a = E.queries()[name](spark, SF_SMALL)
        b = E.queries()[name](spark, tmp_dir)
        assert {r.Timestamp_Rounded for r in a.collect()} == want
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    a, b = (E.queries()["stream_envelope_roundtrip"](spark, d) for d in (SF_SMALL, tmp_dir))
    assert a.count() == b.count() > 0 and a.exceptAll(b).count() == 0


def test_envelopes_of_any_length_and_their_rejects(spark):
    import json
    def env(kind, data, ts="2024-01-01 00:01:02.000000"):
        return json.dumps({"timestamp": ts, "msg_type": kind, "data": data})
    row = '{"Open":1.0,"High":2.0,"Low":0.5,"Close":1.5,"Volume":3.0}'
    msgs = spark.createDataFrame(
        [("a", env("price", [row])), ("b", env("price", [row, row, row])), ("c", env("price", [])),
         ("d", env("odd", [row])), ("e", "{broken"), ("f", env("news", None)), ("g", None)],
        "key string, value string")
    rows = merge.typed_rows(merge.parse_events(msgs)).collect()
    assert sorted(r.key for r in rows) == ["a", "b", "b", "b"] and all(r.High == 2.0 for r in rows)
    assert {r.key: r.reason for r in merge.rejects(msgs).collect()} == {
        "c": "empty", "d": "unknown type", "e": "malformed", "f": "empty", "g": "malformed"}


def test_restart_resumes_from_checkpoint(spark, tmp_dir):
    folder, schema = _staged_events(spark, tmp_dir, parts=2)
    ck, out = f"{tmp_dir}/ck", f"{tmp_dir}/out"
    first = sinks.run_to_parquet(merge.window_merge(tag_events(_stream(spark, folder, schema))),
                                 "t-restart", checkpoint=ck, out=out).count()
    again = sinks.run_to_parquet(merge.window_merge(tag_events(_stream(spark, folder, schema))),
                                 "t-restart", checkpoint=ck, out=out).count()
    assert first == again        # nothing reprocessed or duplicated


def test_envelopes_parse_and_reject_malformed(spark):
    prices = spark.createDataFrame([(1, 10.0, 11.0, 9.0, 10.5, 3.0, "00:01:02", "2024-01-01")],
                                   "id int, Open double, High double, Low double, Close double, "
                                   "Volume double, Time string, Date string")
    news_rows = spark.createDataFrame([(2, "2024-01-01 00:01:30", 0.4)], "id int, pub_date string, score double")
    msgs = publish.publish_prices(prices).unionByName(publish.publish_news(news_rows))
    msgs = msgs.unionByName(spark.createDataFrame([("9", "{not json")], "key string, value string"))
    typed = merge.typed_rows(merge.parse_events(msgs)).orderBy("key").collect()
    assert [t.key for t in typed] == ["1", "2"]
    assert typed[0].ts == dt.datetime(2024, 1, 1, 0, 1, 2) and typed[0].Close == 10.5
    assert typed[1].is_news and typed[1].score == 0.4
    flat = publish.flat_message(prices).first()
    assert flat.key == "1" and '"Open":10.0' in flat.value


def test_kafka_and_console_builders(spark):
    opts = sources.kafka_options("h:9092", "t", '{"t":{"0":0}}', 5)
    assert opts["maxOffsetsPerTrigger"] == "5" and opts["subscribe"] == "t"
    df = spark.readStream.format("rate").load().selectExpr("CAST(value AS STRING) AS key",
                                                           "CAST(value AS STRING) AS value")
    assert sinks.kafka_writer(df, "h:9092", "t", "/tmp/x") is not None
    assert sinks.console_writer(df) is not None


def test_predict_each_batch(spark, tmp_dir):
    x = samples.model_input(bars.minute_features_tagged(tables.tagged_ticks(spark, SF_SMALL)))
    s = samples.build_samples(x, test_starts=50)
    m, acc = model.train(s)
    assert 0.0 <= acc.first().accuracy <= 1.0
    model.save(m, f"{tmp_dir}/model")
    fn = live.predict_each_batch(f"{tmp_dir}/features", f"{tmp_dir}/pred", f"{tmp_dir}/model")
    feats = bars.minute_features_tagged(tables.tagged_ticks(spark, SF_SMALL))
    fn(feats, 0)
    fn(feats, 0)                                   # replay of the same epoch is idempotent
    p = spark.read.parquet(f"{tmp_dir}/pred").collect()
    assert len(p) == 1 and p[0].direction in ("UP", "DOWN")
    # the tail gives the newest window of the whole feature table
    want = samples.latest_sample(samples.model_input(feats)).first()
    assert samples.latest_sample(spark.read.parquet(f"{tmp_dir}/features-tail/epoch=0")).first() == want


def test_predictions_of_a_whole_run_equal_the_batch(spark, tmp_dir):
    """Five micro-batches: every window once, from a tail of one file."""
    from tickwise.plans.model_q import fixed_coefficients
    folder, schema = _staged_events(spark, tmp_dir)
    model.save(model.linear_model(fixed_coefficients(spark)), f"{tmp_dir}/model")
    fn = live.predict_each_batch(f"{tmp_dir}/features", f"{tmp_dir}/pred", f"{tmp_dir}/model",
                                 every_window=True, score=model.score_linear)
    batches, read = [], []

    def run(batch, epoch):
        fn(batch, epoch)
        if epoch == 2:
            fn(batch, epoch)                       # a replayed epoch
        old = live._tail(spark, f"{tmp_dir}/features-tail", epoch)
        batches.append(epoch)
        read.append((len(old.inputFiles()), old.count()))

    sinks.run_each_batch(merge.window_merge(tag_events(_stream(spark, folder, schema))), run, f"{tmp_dir}/ck")
    feats = spark.read.parquet(f"{tmp_dir}/features")
    want = model.score_linear(model.load(f"{tmp_dir}/model"), samples.windows(
        samples.model_input(feats.drop("day", "epoch")))).collect()
    got = spark.read.parquet(f"{tmp_dir}/pred").collect()
    assert len(batches) > 3 and len(want) > 100
    assert sorted((r.start_ts, r.end_ts, round(r.p_up, 9)) for r in got) == \
        sorted((r.start_ts, r.end_ts, round(r.p_up, 9)) for r in want)
    assert all(files <= 1 and rows <= samples.WINDOW for files, rows in read)


@pytest.mark.parametrize("block", [70, 4096])
def test_windows_are_those_of_the_samples(spark, block):
    x = samples.model_input(bars.minute_features_tagged(tables.tagged_ticks(spark, SF_SMALL)))
    every = {r.start_ts: r for r in samples.windows(x, block=block).collect()}
    assert len(every) == x.count() - samples.WINDOW + 1
    for r in samples.build_samples(x, test_starts=50).collect():
        assert every[r.start_ts].features == r.features and every[r.start_ts].end_ts == r.end_ts
    last = samples.latest_sample(x).first()
    assert every[last.start_ts].features == last.features
    assert samples.windows(x.limit(0)).count() == 0


def test_messages_are_counted_in_the_pass(spark, tmp_dir):
    import json
    def env(kind, data):
        return json.dumps({"timestamp": "2024-01-01 00:01:02.000000", "msg_type": kind, "data": data})
    row = '{"Open":1.0,"High":2.0,"Low":0.5,"Close":1.5,"Volume":3.0}'
    data = [("a", env("price", [row])), ("b", env("price", [row, row])), ("c", env("price", [])),
            ("d", env("odd", [row])), ("e", "{broken"), ("f", env("news", None)), ("g", None)]
    msgs = spark.createDataFrame(data, "key string, value string")
    for i in range(3):
        msgs.where(F.pmod(F.ascii("key"), F.lit(3)) == i).coalesce(1).write.parquet(f"{tmp_dir}/in/p{i}")
    counts = {}
    stream = sources.folder_stream(spark, f"{tmp_dir}/in", msgs.schema, max_files_per_trigger=1)
    out = sinks.run_to_parquet(merge.sorted_rows(stream), "t-rejects", counts=counts, partition_by=["reason"])
    assert counts == {"messages.messages": 7, "messages.ok": 2, "messages.malformed": 2,
                      "messages.unknown type": 1, "messages.empty": 2, "messages_rows.rows": 3}
    good = out.where(F.col("reason") == merge.GOOD).drop("value", "reason")
    plain = merge.typed_rows(merge.parse_events(msgs))
    assert good.exceptAll(plain).count() == 0 and good.count() == plain.count() == 3
    bad = {r.key: (r.reason, r.value) for r in out.where(F.col("reason") != merge.GOOD).collect()}
    assert bad == {r.key: (r.reason, r.value) for r in merge.rejects(msgs).collect()}


def test_csv_history_and_cache(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/h")
    with open(f"{tmp_dir}/h/Zed Coin-history.csv", "w") as fh:
        fh.write(',Date,Open*,High,Low,Close**,Volume,Market Cap\n'
                 '0,"Mar 02, 2019",1.0,2.0,0.5,1.5,"1,000",-\n'
                 '1,"Mar 01, 2019",1.1,2.1,0.6,1.4,-,"5,000"\n')
    h = files.read_history(spark, f"{tmp_dir}/h").orderBy("date").collect()
    assert [(r.coin, str(r.date), r.volume, r.market_cap) for r in h] == \
        [("Zed Coin", "2019-03-01", 0, 5000), ("Zed Coin", "2019-03-02", 1000, 0)]
    fr = files.freshness_split(spark, f"{tmp_dir}/h", 7).select("cache_state").distinct().collect()
    assert [r[0] for r in fr] == ["fresh"]
    built = []

    def build():
        built.append(1)
        return spark.createDataFrame([(1,)], "a int")
    files.cached(spark, f"{tmp_dir}/c", build)
    files.cached(spark, f"{tmp_dir}/c", build)
    assert len(built) == 1
    files.write_table(spark.createDataFrame([(1, "x")], "a int, b string"), f"{tmp_dir}/k1", fmt="csv")
    schema = files.with_index_column(spark.createDataFrame([], "a int, b string").schema, "a0")
    back = files.read_csv(spark, f"{tmp_dir}/k1", spark.createDataFrame([], "a int, b string").schema)
    assert back.collect()[0].b == "x" and schema.fieldNames() == ["a0", "a", "b"]


def test_csv_and_text_streams(spark, tmp_dir):
    from tickwise import schemas
    os.makedirs(f"{tmp_dir}/csv")
    os.makedirs(f"{tmp_dir}/txt")
    with open(f"{tmp_dir}/csv/a.csv", "w") as fh:
        fh.write("1,10.0,11.0,9.0,10.5,3.0,00:01:02,2024-01-01\n2,bad,1,1,1,1,00:02:00,2024-01-01\n")
    with open(f"{tmp_dir}/txt/a.json", "w") as fh:
        fh.write('{"timestamp":"2024-01-01 00:00:01","msg_type":"news","data":["{\\"score\\":1.5}"]}\n')
    c = sinks.run_to_parquet(sources.csv_stream(spark, f"{tmp_dir}/csv", schemas.PRICE_ROW,
                                                max_files_per_trigger=1), "t-csv",
                             checkpoint=f"{tmp_dir}/ck3", out=f"{tmp_dir}/o3").orderBy("id").collect()
    assert [r.id for r in c] == [1, 2] and c[1].Open is None        # malformed field -> null
    t = merge.typed_rows(merge.parse_events(
        sources.text_stream(spark, f"{tmp_dir}/txt").withColumn("key", F.lit("k"))))
    got = sinks.run_to_parquet(t, "t-txt", checkpoint=f"{tmp_dir}/ck4", out=f"{tmp_dir}/o4").collect()
    assert got[0].score == 1.5 and got[0].is_news


def test_lookup_rank_metrics_regression_topn(spark):
    from tickwise.operators import filters, stats
    df = spark.createDataFrame([(0, "btc", 1.0, 1.0), (1, "eth", 2.0, 3.0), (2, "xrp", 3.0, 2.0)],
                               "rank int, name string, label double, prediction double")
    assert filters.nth_by_rank(df, "rank", 1).first().name == "eth"
    assert filters.lookup(df, "name", "xrp").first().rank == 2
    m = stats.regression_metrics(df).first()
    assert m.mae == pytest.approx(2 / 3) and m.mse == pytest.approx(2 / 3)
    assert [r.name for r in df.orderBy("label").limit(2).collect()] == ["btc", "eth"]   # O4
    x = samples.model_input(bars.minute_features_tagged(tables.tagged_ticks(spark, SF_SMALL)))
    s = model.assemble(samples.build_samples(x, test_starts=50).where("split = 'train'"), label="y1")
    fit = model.regressor("linear").fit(s)
    assert "prediction" in fit.transform(s).columns


def test_minute_timers_emit_and_clear(spark, tmp_dir):
    """Five micro-batches, a restart and a late batch; state falls as minutes are emitted."""
    folder, schema = _staged_events(spark, tmp_dir)
    out, batch = f"{tmp_dir}/out", {r.Timestamp_Rounded: r for r in bars.minute_features_tagged(
        tables.tagged_ticks(spark, SF_SMALL)).collect()}

    def run():
        w = (timers.timer_merge(tag_events(_stream(spark, folder, schema))).writeStream.format("parquet")
             .option("path", out).option("checkpointLocation", f"{tmp_dir}/ck").outputMode("append")
             .trigger(availableNow=True))
        before = spark.conf.get("spark.sql.shuffle.partitions")
        q = sinks.start_to_end(w, spark, {**timers.STORE, "spark.sql.shuffle.partitions": "2"})
        assert spark.conf.get("spark.sql.shuffle.partitions") == before
        return [p.stateOperators[0].numRowsTotal for p in q.recentProgress if p.stateOperators]

    held = run()
    first = spark.read.parquet(out).count()
    assert 0 < first < len(batch) and min(held[1:]) < max(held)
    run()                                                    # a restart without new input
    assert spark.read.parquet(out).count() == first
    last = max(batch) + dt.timedelta(days=1)
    spark.createDataFrame([(-1, last, 0, "view", 1.0, '{"k": 1}')], schema).coalesce(1) \
        .write.parquet(f"{folder}/late")
    held = run()
    got = spark.read.parquet(out).collect()
    assert sorted(r.Timestamp_Rounded for r in got) == sorted(batch)
    for r in got:
        _same_row(r, batch[r.Timestamp_Rounded])
    assert held[-1] < 10                                     # the late minute alone is held

"""Edge rows shared by the operator tests."""

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "fp long, key string, root long, found string, owner string, `a.b` int")

WORDS = ("the river carried small boats past old mills and quiet farms while people on the bank "
         "watched lanterns move slowly toward the harbour before rain began to fall again").split()


def prose(n, seed=0):
    return " ".join(WORDS[(i * 7 + seed * 3 + i // 11) % len(WORDS)] + ("." if i % 9 == 8 else "")
                    for i in range(n))


def edge_rows():
    extra = (1, "k", 2, "f", "o", 3)
    long_text = " ".join(f"w{i}" for i in range(30_000)) + " " + "x" * 50_000
    rows = [
        (1, prose(80, 1), "en", "s1", 5), (1, prose(80, 1), "en", "s1", 5),   # repeated row
        (1, prose(90, 5), "en", "s2", 5),                                     # same id, other text
        (2, None, "en", "s1", None), (3, "", None, None, 0), (None, prose(40, 2), "de", None, 1),
        (None, prose(40, 2), "de", None, 1), (4, long_text, "xx", "s3", 1),
        (5, " \t\n\x0b\x0c\r", "en", "s1", 6), (6, "é́ 😀 \x1c   ｆ", "fr", "s1", 9),
        (7, prose(80, 1) + " end", "en", "s4", 5), (None, None, None, None, None),
    ]
    return [r + extra for r in rows]


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)

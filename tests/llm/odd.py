"""Small tables with every kind of odd row."""

from __future__ import annotations

LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))

TEXTS = [
    (1, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"),
    (2, "One two three four five six seven eight nine ten eleven twelve thirteen fourteen"),
    (3, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"),
    (3, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"),
    (4, None),
    (5, ""),
    (6, " \t\n"),
    (7, "é ß 東京 \u00a0x İ"),
    (8, LONG),
    (9, LONG + " end"),
    (10, "a"),
    (11, "a" * 200_000),
    (12, "mail a.b@c.example.org or +1 (555) 123-4567, 10.0.0.1, 4111 1111 1111 1111"),
    (13, "Licensed under the Apache License, Version 2.0. GNU General Public License"),
    (None, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"),
    (None, None),
]

# Names that operators use themselves.
CLASHING = "n long, size string, target string, kept string, key long, digest string, host int, rank int"


def documents(spark, texts=TEXTS):
    rows = [
        (d, t, [None, "en", "de"][i % 3], [None, "s1", "s2", "s1"][i % 4], len(t) if t else None, i, "x", None, "no", 7, "d", 1, 2)
        for i, (d, t) in enumerate(texts)
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + CLASHING
    return spark.createDataFrame(rows, schema)


def empty(spark):
    return documents(spark).limit(0)


def labels(spark, ids=(1, 2, 3, 7, 8, 9, 10, 12, 13)):
    rows = [(i, 1, 0) for i in ids] + [(None, 1, 0), (4, None, 0), (5, 0, None), (1, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")

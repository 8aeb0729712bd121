import random

from tillroll.llm import line_dedup

SCHEMA = "doc_id long, text string, at string, row string, lines string"


def _brute(rows):
    """rows: (id, text) in input order; ties of the id keep that order."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i))
    seen, out = set(), [None] * len(rows)
    for i in order:
        text = rows[i][1]
        lines = [] if text is None else text.split("\n")
        gone = set()
        for at in range(len(lines) - 2):
            w = tuple(lines[at:at + 3])
            if w in seen:
                gone |= {at, at + 1, at + 2}
            seen.add(w)
        out[i] = (rows[i][0], None if text is None else
                  "\n".join(x for j, x in enumerate(lines) if j not in gone), len(lines), len(gone))
    return out


def _run(spark, rows):
    df = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], SCHEMA).coalesce(1)
    out = line_dedup.drop_lines(df)
    assert out.columns == [*df.columns, "n_lines", "n_removed_lines"]
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_removed_lines) for r in out.collect()), key=str)


def test_random_lines_against_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, "\n".join(rng.choice("ab\r ") for _ in range(rng.randrange(12)))) for i in range(120)]
    assert _run(spark, rows) == sorted(_brute(rows), key=str)


def test_hot_window_copies_and_odd_rows(spark):
    hot = "same\nthree\nlines"
    rows = [(i, f"x{i}\n{hot}\ny{i}") for i in range(300)] + [(1000, "only\ntwo"), (1001, "only\ntwo"),
            (1002, None), (1003, ""), (1004, ""), (None, hot), (1005, "\n\n\n\n"), (1006, "long\n" * 5000)]
    rows += [(2000, "a\nb\nc\nd")] * 3
    assert _run(spark, rows) == sorted(_brute(rows), key=str)


def test_empty_table(spark):
    assert _run(spark, []) == []

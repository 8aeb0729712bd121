"""Line dedup by overlapping three-line windows.

Every run of three consecutive lines is a window, known by a 128-bit hash of
its lines. The first occurrence of a window, in the order (document id, row,
line), stays; the lines of every later occurrence go. Overlapping later
windows cover their lines together, so a repeated passage of any length goes
as one piece, whatever stands around it, while a single common line stays.
All windows are judged on the input texts.

Only hashes and positions are shuffled to find the repeats. A window that
holds a large part of all occurrences is counted map-side; its occurrences
are then compared with a broadcast first place, not sent to one task.

Rows: a null text stays null, an empty one empty. A text of fewer than three
lines has no window and stays. Lines end at a line feed; a carriage return is
part of its line, and blank lines are lines. Repeated rows and copies of a
text lose all their repeated lines but for the first row. A null id sorts
first. No rows give no rows. Columns pass through; only ``text`` and, if the
table has it, a count of characters change.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import internal, lookup_split, returns_memory, store, table, with_row_id

WINDOW = 3


def windows(df: DataFrame, row: str, order: str, text: str, size: int = WINDOW) -> DataFrame:
    """(h1, h2, row, id, at): one row for each window of ``size`` lines."""
    lines = F.split(F.col(f"`{text}`"), "\n", -1)
    hashes = F.transform(
        F.sequence(F.lit(0), F.size("lines") - size),
        lambda i: F.struct(
            F.xxhash64(*[F.get(F.col("lines"), i + j) for j in range(size)]).alias("h1"),
            F.xxhash64(F.lit(size), *[F.get(F.col("lines"), i + j) for j in range(size)]).alias("h2")))
    return (df.select(F.col(row).alias("row"), F.col(f"`{order}`").alias("id"), lines.alias("lines"))
            .where(F.size("lines") >= size)
            .select("row", "id", F.posexplode(hashes).alias("at", "h"))
            .select("h.h1", "h.h2", "row", "id", "at"))


def later_windows(found: DataFrame) -> DataFrame:
    """(row, at) of every window that occurs earlier, in the order (id, row, at)."""
    place = F.struct("id", "row", "at")
    firsts = store(found.groupBy("h1", "h2")
                   .agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
                   .where(F.col("n") > 1), "line-windows")
    total = int(firsts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    return (lookup_split(found, firsts, ["h1", "h2"], "n", total, F.xxhash64("row", "at"))
            .where(F.col("n").isNotNull() & (F.col("first") != place)).select("row", "at"))


def drop_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = WINDOW,
               lines_out: str = "n_lines", removed_out: str = "n_removed_lines") -> DataFrame:
    """``df`` with the lines of later windows taken out of ``text``, and the
    counts of lines before and removed (0 for a null text)."""
    df = df.drop(lines_out, removed_out)
    row, starts, result = internal(df, "__row", "__starts", "__result")
    numbered = with_row_id(df, row)
    cover = (later_windows(windows(numbered, row, doc_id, text, size))
             .groupBy(F.col("row").alias(row)).agg(F.collect_set("at").alias(starts)))

    @F.arrow_udf("struct<text:string,lines:long,removed:long>")
    @returns_memory
    def strip(texts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for values, places in texts:
            out, lines, removed = [], [], []
            for value, at in zip(values, places):
                value, at = value.as_py(), at.as_py()
                n = 0 if value is None else value.count("\n") + 1
                gone = 0
                if value is not None and at:
                    keep = _uncovered(np.array(at), n, size)
                    gone = n - int(keep.sum())
                    value = "\n".join(x for x, k in zip(value.split("\n"), keep) if k)
                out.append(value)
                lines.append(n)
                removed.append(gone)
            yield pa.StructArray.from_arrays(
                [pa.array(out, pa.string()), pa.array(lines, pa.int64()), pa.array(removed, pa.int64())],
                ["text", "lines", "removed"])

    # not to be run again for a filter on what it returns
    joined = numbered.join(cover, row, "left").withColumn(
        result, strip.asNondeterministic()(F.col(f"`{text}`"), F.col(starts)))
    return joined.select(
        *[F.col(f"{result}.text").alias(c) if c.lower() == text.lower() else F.col(f"`{c}`") for c in df.columns],
        F.col(f"{result}.lines").alias(lines_out), F.col(f"{result}.removed").alias(removed_out))


def _uncovered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which of ``n`` lines no window of ``size`` lines from ``starts`` covers."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + size, -1)
    return np.cumsum(edges)[:n] == 0


def without_repeats(spark, sf_dir: str) -> DataFrame:
    """Every document with its repeated three-line windows removed."""
    return drop_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


ORACLE = """
    WITH docs AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
    places AS (
      SELECT doc_id, place, lines[place + 1] || chr(10) || lines[place + 2] || chr(10) || lines[place + 3] AS w
      FROM (SELECT doc_id, lines, unnest(range(len(lines) - 2)) AS place FROM docs WHERE len(lines) >= 3)
    ),
    later AS (
      SELECT doc_id, place FROM (
        SELECT doc_id, place, row_number() OVER (PARTITION BY w ORDER BY doc_id, place) AS r FROM places)
      WHERE r > 1
    ),
    covered AS (SELECT DISTINCT doc_id, place + o.o AS line FROM later, (SELECT unnest([0, 1, 2]) AS o) o),
    kept AS (
      SELECT d.doc_id, d.place AS line, d.l
      FROM (SELECT doc_id, unnest(lines) AS l, unnest(range(len(lines))) AS place FROM docs) d
      ANTI JOIN covered c ON c.doc_id = d.doc_id AND c.line = d.place
    ),
    texts AS (SELECT doc_id, string_agg(l, chr(10) ORDER BY line) AS text, count(*) AS n FROM kept GROUP BY doc_id)
    SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(t.text, '') END AS text,
           CAST(coalesce(len(d.lines), 0) AS BIGINT) AS n_lines,
           CAST(coalesce(len(d.lines), 0) - coalesce(t.n, 0) AS BIGINT) AS n_removed_lines
    FROM docs d LEFT JOIN texts t ON t.doc_id = d.doc_id"""

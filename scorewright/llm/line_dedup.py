"""Line dedup: lines that many documents share are dropped everywhere, natively in Spark.

Lines are exploded with their position, normalised and hashed (128 bits); a document counts once for each
hash. Only (hash, document) pairs are shuffled to be counted, first made distinct in the tasks, so one
line found in a third of all documents is counted from partial sums and never gathered. The hashes
over the threshold are written to the shared folder: Spark knows their measured size then, and joins them to the
lines where these lie if they are small, or in a sorted join of plain scans, whose hot hashes it splits,
if they are not. The dropped positions meet the document once, and the text is put
together from the other positions in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from scorewright.llm.base import LOWER, SPACES, UPPER, boxed, field, unboxed
from scorewright.session import stage


def line_key(line: Column) -> Column:
    """The form in which lines are compared: blanks stripped at both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(SPACES)), UPPER, LOWER)


def dedup_lines(
    docs: DataFrame,
    min_docs: int = 10,
    min_chars: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    counts: tuple[str, str] | None = ("n_lines", "n_dropped"),
) -> DataFrame:
    """``docs`` with every line gone whose key is in at least ``min_docs`` documents.

    Keys shorter than ``min_chars`` code points always stay. ``counts`` names two columns that are
    added (or replaced): lines before dropping, and lines dropped; None adds neither.

    Null or empty text: one empty line, text "". Rows that share an id count as one document and are
    all cleaned; a null id is an id of its own. A document may lose all its lines (text "").
    An empty table gives an empty table; other columns pass through.
    """
    base = boxed(docs).withColumns({"text": F.coalesce(field(text_col), F.lit("")), "doc": field(id_col)})
    base = base.withColumn("rev", F.xxhash64("text"))
    exploded = base.select("doc", "rev", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    key = line_key(F.col("line"))
    # Two hashes of different seeds: 64 bits are too few for the lines of a whole crawl.
    keyed = exploded.select("doc", "rev", "pos", key.alias("key")).where(F.length("key") >= min_chars).select(
        "doc", "rev", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")
    )
    frequent = (
        keyed.select("h1", "h2", "doc")
        .distinct()
        .groupBy("h1", "h2")
        .agg(F.count(F.lit(1)).alias("docs"))
        .where(F.col("docs") >= min_docs)
        .select("h1", "h2")
    )
    dropped = (
        keyed.join(stage(frequent), ["h1", "h2"])
        .groupBy(F.col("doc").alias("drop_doc"), F.col("rev").alias("drop_rev"))
        .agg(F.collect_set("pos").alias("drop"))
    )
    joined = base.join(
        dropped, F.col("doc").eqNullSafe(F.col("drop_doc")) & (F.col("rev") == F.col("drop_rev")), "left"
    )
    n_lines = F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1
    kept = F.array_except(F.sequence(F.lit(0), n_lines - 1), F.col("drop"))
    # One-element array: the split text is bound once, then read by position.
    rebuilt = F.element_at(
        F.transform(
            F.array(F.split("text", "\n", -1)),
            lambda lines: F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n"),
        ),
        1,
    )
    added = {text_col: F.when(F.col("drop").isNull(), F.col("text")).otherwise(rebuilt)}
    if counts:
        added[counts[0]] = n_lines.cast("long")
        added[counts[1]] = F.when(F.col("drop").isNull(), F.lit(0)).otherwise(F.size("drop")).cast("long")
    return unboxed(joined, docs.columns, added)

"""Quality rules: a threshold table compiled into one projection, evaluated in the JVM.

Every measure is an expression over the document's own row: no shuffle, no explode, no user
function. Values that several expressions share are bound once as one-element arrays, so the text is
split once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from scorewright.llm.base import LOWER, SPACES, UPPER, boxed, field, unboxed, words

SYMBOLS = "#*$%&|<>"

#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "it", "for", "was", "on", "with", "as", "be", "this", "are", "or", "from",
    "de", "la", "le", "les", "et", "des", "en", "un", "une", "du", "dans", "que", "qui", "par", "pour", "sur", "au", "est",
    "der", "die", "und", "den", "das", "von", "zu", "mit", "im", "ist", "ein", "eine", "nicht", "auf", "dem", "für",
    "el", "los", "las", "y", "por", "con", "una", "del", "se", "no", "para", "al", "su",
)

#: (measure, lowest allowed, highest allowed); None leaves a side open.
RULES = (
    ("mean_word_chars", 2.0, 15.0),
    ("symbol_ratio", None, 0.1),
    ("dup_line_ratio", None, 0.5),
    ("upper_ratio", None, 0.3),
    ("stop_word_ratio", 0.02, None),
)


def _bind(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(ws: Column) -> Column:
    """Words lying in a 3-word window that is found twice or more, its first place included.

    Windows are compared by a pair of 64-bit hashes. Texts without a repeated window, most of them,
    stop after counting distinct hashes; the others are sorted by (hash, place), and equal neighbours
    mark their places.
    """
    second, third = F.slice(ws, 2, F.size(ws)), F.slice(ws, 3, F.size(ws))
    windows = F.filter(
        F.zip_with(
            F.zip_with(ws, second, lambda a, b: F.struct(a.alias("a"), b.alias("b"))),
            third,
            lambda p, c: F.when(c.isNotNull(), F.xxhash64(p["a"], F.lit(1), p["b"], F.lit(2), c)),
        ),
        lambda h: h.isNotNull(),
    )

    def marked(hashes: Column) -> Column:
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            pairs = F.zip_with(
                s,
                F.slice(s, 2, F.size(s)),
                lambda x, y: F.when(x["h"] == y["h"], F.array(x["i"], y["i"])),
            )
            hit = F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull())))
            covered = F.flatten(F.transform(hit, lambda i: F.array(i, i + 1, i + 2)))
            return F.size(F.array_distinct(covered))

        return _bind(placed, places)

    count = lambda hs: F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0)).otherwise(marked(hs))
    return F.when(F.size(ws) < 4, F.lit(0)).otherwise(_bind(windows, count)).cast("long")


def measures(text: Column) -> Column:
    """Struct of all counts of a text; null text counts as empty."""
    text = F.coalesce(text, F.lit(""))

    def counted(ws: Column) -> Column:
        return F.struct(
            F.size(ws).cast("long").alias("n_words"),
            F.length(F.array_join(ws, "")).cast("long").alias("word_chars"),
            repeated_words(ws).alias("n_repeat_words"),
            F.size(F.filter(ws, lambda w: F.translate(w, UPPER, LOWER).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
        )

    def by_line(lines: Column) -> Column:
        return F.struct(
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        )

    lines = F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    return F.struct(
        _bind(words(text), counted).alias("w"),
        _bind(lines, by_line).alias("l"),
        F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit("[A-Z]")).cast("long").alias("n_upper"),
    )


def score_quality(docs: DataFrame, rules=RULES, text_col: str = "text", name: str = "quality") -> DataFrame:
    """``docs`` plus a struct column ``name`` of counts, ratios, ``base_failed`` and ``kept``.

    base_failed: fewer than 50 words, or more than half of the words in repeated 3-word windows.
    kept: not base_failed, and every rule of the table holds; a ratio over nothing is 0.

    Null, empty and blank texts have no word, so they fail. Rows are judged one by one: ties, repeats
    and other columns play no part (a column called ``name`` is replaced). Empty in, empty out.
    """
    m = F.col("m")
    n = m["w"]["n_words"]
    share = lambda x, y: F.when(y > 0, x / y).otherwise(F.lit(0.0))
    values = {
        "mean_word_chars": share(m["w"]["word_chars"], n),
        "symbol_ratio": share(m["n_symbols"], n),
        "dup_line_ratio": share(m["l"]["n_dup_lines"], m["l"]["n_lines"]),
        "upper_ratio": share(m["n_upper"], m["w"]["word_chars"]),
        "stop_word_ratio": share(m["w"]["n_stop_words"], n),
    }
    failed = (n < 50) | (m["w"]["n_repeat_words"] * 100 > n * 50)
    holds = ~failed
    for measure, low, high in rules:
        if low is not None:
            holds = holds & (values[measure] >= low)
        if high is not None:
            holds = holds & (values[measure] <= high)
    counts = {
        "n_words": n, "word_chars": m["w"]["word_chars"], "n_symbols": m["n_symbols"], "n_dup_lines": m["l"]["n_dup_lines"],
        "n_repeat_words": m["w"]["n_repeat_words"], "n_stop_words": m["w"]["n_stop_words"], "n_upper": m["n_upper"], "n_lines": m["l"]["n_lines"],
    }
    fields = [v.alias(k) for k, v in (counts | values | {"base_failed": failed, "kept": holds}).items()]
    return unboxed(boxed(docs).withColumn("m", measures(field(text_col))), docs.columns, {name: F.struct(*fields)})

"""Quality rules: plain counts, and how far a document's characters and words diverge from its language.

Built-in functions only: texts stay in the JVM, whole, and are read twice. The first reading
counts the words of each language, from which the references are made; the second counts each
document and compares. Only the references, whose size is bounded, are broadcast.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edgelens.llm.scratch import Scratch

#: Fixed values of the base rules.
WORD = r"[^\x20\x09-\x0D]+"
#: What lies between two words, one by one, which Java looks up in a table.
GAP = r"[ \t\n\x0B\f\r]+"
SYMBOLS = "#*$%&|<>"
WINDOW, LEAST_WORDS, MOST_REPEATED = 5, 10, 20
#: What a character of a word counts as: the first class that it fits; none is ``other``.
CLASSES = {
    "lower": "[a-z]+", "upper": "[A-Z]+", "letter": r"\p{L}+", "digit": "[0-9]+", "stop": r"[.,;:'\"()?!-]+",
}
BINS = (*CLASSES, "other")
#: Common words of a reference. A language has its own if its words are this share of all and
#: this many at least, so there are 1000 references at most; others use all documents'.
COMMON_WORDS, LEAST_SHARE, LEAST_REFERENCE = 32, 0.001, 2000
#: Shorter documents are not compared: by words in the one case, by their characters in the other.
GUARD_WORDS, GUARD_CHARS = 25, 100
#: Divergences allowed, in bits, beyond what chance gives a document of its length.
MOST_CLASS_DIVERGENCE, MOST_WORD_DIVERGENCE = 0.06, 0.15


def _named(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _words(text: Column) -> Column:
    """The words of a text, in order; text before the first and after the last gap may be empty."""
    return F.array_remove(F.split(text, GAP), "")


def _with_classes(df: DataFrame, characters: Column) -> DataFrame:
    """Adds ``c_<class>``, the characters of each class; each step reads what the last one left."""
    df = df.withColumn("_left", characters)
    for name, pattern in CLASSES.items():
        df = df.withColumn("_rest", F.regexp_replace("_left", pattern, ""))
        df = df.withColumn(f"c_{name}", (F.char_length("_left") - F.char_length("_rest")).cast("long"))
        df = df.withColumn("_left", F.col("_rest"))
    return df.withColumn("c_other", F.char_length("_left").cast("long")).drop("_left", "_rest")


def _divergence(p: Column, q: Column) -> Column:
    """One bin's part of the Jensen-Shannon divergence, in bits."""
    def part(x: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (p + q))).otherwise(0.0)

    return (part(p) + part(q)) / 2


def _allowed(most: float, bins: int, n: Column) -> Column:
    """``most``, and the divergence that ``n`` draws from the reference itself give on average."""
    return F.lit(most) + F.lit((bins - 1) / (8 * math.log(2))) / n


def language_references(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", scratch: Scratch | None = None
) -> DataFrame:
    """One row per language with a reference of its own, and one of all documents for the rest.

    Columns: ``lang``, ``pooled`` (the row of all documents, its ``lang`` null), ``words`` (the
    common ones, most frequent first, ties by code point), ``word_p`` (their shares, and last
    that of all other words), ``q_<class>`` (shares of the classes). Every word of every
    document counts. Tables without any word give no row.
    """
    scratch = scratch or Scratch(docs.sparkSession, "quality")
    words = docs.select(
        _named(lang_col).cast("string").alias("lang"),
        F.explode(_words(_named(text_col))).alias("word"),
    )
    counts = scratch.keep(words.groupBy("lang", "word").agg(F.count("*").alias("n")), "words")

    sums = [F.sum(F.col("n") * F.col(f"c_{x}")).alias(f"c_{x}") for x in BINS]
    classed = _with_classes(counts, F.col("word"))
    classes = scratch.keep(classed.groupBy("lang").agg(F.sum("n").alias("total"), *sums), "classes")
    total = classes.agg(F.sum("total")).first()[0] or 0
    own = classes.where(f"total >= {max(LEAST_REFERENCE, LEAST_SHARE * total)} AND lang IS NOT NULL")
    pooled = classes.agg(F.sum("total").alias("total"), *(F.sum(f"c_{x}").alias(f"c_{x}") for x in BINS))
    pooled = pooled.where("total > 0").select(F.lit(None).cast("string").alias("lang"), "*")

    lower = counts.select("lang", F.lower("word").alias("word"), "n")
    order = [F.desc("n"), F.col("word")]
    per_lang = lower.join(F.broadcast(own.select("lang")), "lang").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    turn = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    common = per_lang.withColumn("turn", turn).where(f"turn <= {COMMON_WORDS}").drop("turn")
    of_all = lower.groupBy("word").agg(F.sum("n").alias("n")).orderBy(*order).limit(COMMON_WORDS)
    common = common.unionByName(of_all.select(F.lit(None).cast("string").alias("lang"), "*"))
    # 32 words a language
    common = common.groupBy(F.col("lang").alias("_lang")).agg(
        F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("less"), "word"))).alias("common"),
        F.sum("n").alias("n_common"),
    )
    characters = sum((F.col(f"c_{x}") for x in BINS), F.lit(0))
    return (
        own.unionByName(pooled)
        .join(common, F.col("lang").eqNullSafe(F.col("_lang")))
        .select(
            "lang",
            F.col("lang").isNull().alias("pooled"),
            F.transform("common", lambda x: x["word"]).alias("words"),
            F.concat(
                F.transform("common", lambda x: -x["less"] / F.col("total")),
                F.array((F.col("total") - F.col("n_common")) / F.col("total")),
            ).alias("word_p"),
            *((F.col(f"c_{x}") / characters).alias(f"q_{x}") for x in BINS),
        )
    )


def base_counts(docs: DataFrame, text: Column) -> DataFrame:
    """Adds the counts of the base rules, ``base_failed`` and ``_words`` to ``docs``.

    Windows of words are compared by 64-bit hashes, made of the words' hashes in three steps: a
    document of n words is miscounted with a chance of n**2 / 2**63 at most. Only a text with a
    repeated window sorts them.
    """
    n = F.size("_words")
    docs = docs.withColumn("_text", F.coalesce(text, F.lit("")))
    docs = docs.withColumn("_words", _words(F.col("_text")))
    lines = F.filter(F.split("_text", "\n"), lambda line: line.rlike(WORD))
    docs = docs.withColumn("_lines", lines)
    docs = docs.withColumn("_chars", F.array_join("_words", ""))
    docs = docs.select(
        *docs.columns,
        n.cast("long").alias("n_words"),
        F.char_length("_chars").cast("long").alias("word_chars"),
        (F.char_length("_chars") - F.char_length(F.regexp_replace("_chars", "[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
    )
    # windows of 1, 2, 4 and then all words; those that reach beyond the last word are cut off
    joined = "zip_with({}, slice({}, {}, size(_words)), (a, b) -> xxhash64(a, b))"
    docs = docs.withColumn("_one", F.expr("transform(_words, w -> xxhash64(w))"))
    docs = docs.withColumn("_two", F.expr(joined.format("_one", "_one", 2)))
    docs = docs.withColumn("_four", F.expr(joined.format("_two", "_two", 3)))
    whole = f"greatest(size(_words) - {WINDOW - 1}, 0)"
    docs = docs.withColumn("_windows", F.expr(f"slice({joined.format('_four', '_one', WINDOW)}, 1, {whole})"))
    # the repeated windows side by side, each with its place
    placed = "sort_array(transform(_windows, (h, i) -> struct(h AS h, i AS i)))"
    none = "CAST(array() AS array<struct<h: bigint, i: int>>)"
    docs = docs.withColumn(
        "_sorted", F.expr(f"if(size(array_distinct(_windows)) = size(_windows), {none}, {placed})")
    )
    repeated = "filter(_sorted, (s, i) -> get(_sorted, i - 1).h <=> s.h OR get(_sorted, i + 1).h <=> s.h)"
    places = f"sort_array(transform({repeated}, s -> s.i))"
    # each window adds the words that the one before did not hold
    covered = (
        f"aggregate({places}, struct(0L AS n, 0 AS upto), "
        f"(a, i) -> struct(a.n + (i + {WINDOW} - greatest(a.upto, i)) AS n, i + {WINDOW} AS upto), a -> a.n)"
    )
    docs = docs.withColumn("n_repeat_words", F.expr(covered)).drop(
        "_text", "_lines", "_one", "_two", "_four", "_windows", "_sorted"
    )
    failed = f"n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words"
    return docs.withColumn("base_failed", F.expr(failed))


def quality_rules(
    docs: DataFrame,
    references: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """The counts of the base rules and the verdict ``kept`` for each row of ``docs``.

    Returns (id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    class_divergence, word_divergence, kept). A document that passes the base rules is kept if
    the shares of its character classes and of the common words (lower-cased) diverge from
    those of its language by no more than the limits, Jensen-Shannon, in bits. Divergences are
    null, and not tested, for documents below the guards.

    A null text counts as empty, has no words and fails. A null or rare language is compared
    with all documents together. Repeated rows and null ids give a row each; other columns of
    ``docs`` are not read, whatever their names. An empty table gives an empty result.
    """
    references = language_references(docs, text_col, lang_col) if references is None else references
    references = Scratch(docs.sparkSession, "quality").keep(references, "references")
    pooled = references.where("pooled").first()  # at most one row
    # at most COMMON_WORDS for each reference
    any_common = [r[0] for r in references.select(F.explode("words")).distinct().collect()]
    own = references.where("NOT pooled").drop("pooled").withColumnRenamed("lang", "_lang")

    rows = docs.select(
        _named(id_col).alias("_id"), _named(lang_col).cast("string").alias("_own"), _named(text_col).alias("_source")
    )
    rows = base_counts(rows, F.col("_source")).drop("_source")
    rows = _with_classes(rows, F.col("_chars")).drop("_chars")
    rows = rows.join(F.broadcast(own), F.col("_own") == F.col("_lang"), "left").drop("_lang", "_own")
    if pooled is None:
        pooled = {"words": [], "word_p": [1.0], **{f"q_{x}": 0.0 for x in BINS}}
    words = F.array(*(F.lit(x) for x in pooled["words"])).cast("array<string>")
    rows = rows.withColumns(
        {
            "words": F.coalesce("words", words),
            "word_p": F.coalesce("word_p", F.array(*(F.lit(x) for x in pooled["word_p"]))),
            **{f"q_{x}": F.coalesce(f"q_{x}", F.lit(pooled[f"q_{x}"])) for x in BINS},
        }
    )
    class_parts = (_divergence(F.col(f"c_{x}") / F.col("word_chars"), F.col(f"q_{x}")) for x in BINS)
    # one look-up tells most words from the common ones; those are then taken away word by word
    lower = F.transform("_words", F.lower)
    rows = rows.withColumn("_common", F.filter(lower, lambda w: w.isin(any_common)))
    left = F.aggregate(
        "words",
        F.struct(F.col("_common").alias("rest"), F.array().cast("array<int>").alias("sizes")),
        lambda a, w: F.struct(
            F.array_remove(a["rest"], w).alias("rest"), F.concat(a["sizes"], F.array(F.size(a["rest"]))).alias("sizes")
        ),
        lambda a: F.concat(a["sizes"], F.array(F.size(a["rest"]))),
    )
    rows = rows.withColumn("_left", left)
    found = F.transform("words", lambda w, i: F.get("_left", i) - F.get("_left", i + 1))
    others = F.col("n_words").cast("int") - F.get("_left", F.lit(0)) + F.element_at("_left", -1)
    rows = rows.withColumn("_found", F.concat(found, F.array(others)))
    word_parts = F.zip_with("_found", "word_p", lambda n, q: _divergence(n / F.col("n_words"), q))
    judged = ~F.col("base_failed")
    rows = rows.select(
        "*",
        F.when(judged & (F.col("word_chars") >= GUARD_CHARS), sum(class_parts, F.lit(0.0))).alias("class_divergence"),
        F.when(
            judged & (F.col("n_words") >= GUARD_WORDS), F.aggregate(word_parts, F.lit(0.0), lambda a, x: a + x)
        ).alias("word_divergence"),
    )
    class_fits = F.col("class_divergence") <= _allowed(MOST_CLASS_DIVERGENCE, len(BINS), F.col("word_chars"))
    word_fits = F.col("word_divergence") <= _allowed(MOST_WORD_DIVERGENCE, COMMON_WORDS + 1, F.col("n_words"))
    kept = judged & F.coalesce(class_fits, F.lit(True)) & F.coalesce(word_fits, F.lit(True))
    return rows.select(
        F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "class_divergence", "word_divergence", kept.alias("kept"),
    )


def _class_sql(source: str) -> str:
    """SELECT list with the characters of each class of ``source``."""
    left, parts = source, []
    for name, pattern in CLASSES.items():
        rest = f"regexp_replace({left}, '{pattern.replace(chr(39), chr(39) * 2)}', '', 'g')"
        parts.append(f"length({left}) - length({rest}) AS c_{name}")
        left = rest
    return ", ".join([*parts, f"length({left}) AS c_other"])


def _divergence_sql(p: str, q: str) -> str:
    parts = (f"CASE WHEN {x} > 0 THEN {x} * log2(2 * {x} / ({p} + {q})) ELSE 0 END" for x in (p, q))
    return f"({' + '.join(parts)}) / 2"


#: The query's rows, worked out by unnesting words and windows.
ORACLE_SQL = f"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t FROM documents
),
split AS (
    SELECT *, regexp_extract_all(t, '{WORD}') AS ws, regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g') AS chars,
           list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines
    FROM texts
),
words AS (SELECT r, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM split),
windows AS (
    SELECT r, i, concat_ws(' ', w, {", ".join(f"lead(w, {j}) OVER o" for j in range(1, WINDOW))}) AS x
    FROM words WINDOW o AS (PARTITION BY r ORDER BY i) QUALIFY lead(w, {WINDOW - 1}) OVER o IS NOT NULL
),
found AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, x) > 1),
covered AS (
    SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest(range(i, i + {WINDOW})) AS place FROM found) GROUP BY r
),
based AS (
    SELECT s.*, len(ws) AS n_words, length(chars) AS word_chars,
           length(chars) - length(regexp_replace(chars, '[{SYMBOLS}]+', '', 'g')) AS n_symbols,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
           len(ws) < {LEAST_WORDS} OR 100 * coalesce(n, 0) > {MOST_REPEATED} * len(ws) AS base_failed
    FROM split s LEFT JOIN covered USING (r)
),
counts AS (SELECT lang, w, count(*) AS n FROM (SELECT lang, unnest(ws) AS w FROM split) GROUP BY ALL),
both_kinds AS (SELECT * FROM counts UNION ALL SELECT NULL, w, sum(n) FROM counts GROUP BY w),
own AS (
    SELECT lang FROM counts WHERE lang IS NOT NULL GROUP BY lang
    HAVING sum(n) >= greatest({LEAST_REFERENCE}, {LEAST_SHARE} * (SELECT sum(n) FROM counts))
),
named AS (
    SELECT * FROM both_kinds WHERE lang IN (FROM own)
    UNION ALL SELECT NULL, w, sum(n) FROM counts GROUP BY w
),
classes AS (
    SELECT lang, sum(n) AS total, {", ".join(f"sum(n * c_{x}) AS k_{x}" for x in BINS)}
    FROM (SELECT *, {_class_sql("w")} FROM named) GROUP BY lang
),
common AS (
    SELECT lang, w, sum(n) AS n FROM (SELECT lang, lower(w) AS w, n FROM named) GROUP BY lang, w
    QUALIFY row_number() OVER (PARTITION BY lang ORDER BY sum(n) DESC, w) <= {COMMON_WORDS}
),
judged AS (
    SELECT b.*, c.* EXCLUDE (lang), {_class_sql("chars")}, c.lang AS ref
    FROM based b JOIN classes c ON c.lang IS NOT DISTINCT FROM (CASE WHEN b.lang IN (FROM own) THEN b.lang END)
    WHERE NOT base_failed
),
hits AS (
    SELECT r, w, count(*) AS found FROM (SELECT r, lower(unnest(ws)) AS w FROM split) GROUP BY ALL
),
bins AS (
    SELECT j.r, coalesce(found, 0) / n_words AS p, n / total AS q
    FROM judged j JOIN common k ON k.lang IS NOT DISTINCT FROM j.ref LEFT JOIN hits h ON h.r = j.r AND h.w = k.w
),
all_bins AS (
    FROM bins UNION ALL SELECT r, greatest(1 - sum(p), 0), greatest(1 - sum(q), 0) FROM bins GROUP BY r
),
word_divergence AS (SELECT r, sum({_divergence_sql("p", "q")}) AS d FROM all_bins GROUP BY r),
verdicts AS (
    SELECT j.r, (n_words < {GUARD_WORDS} OR d <= {MOST_WORD_DIVERGENCE} + {COMMON_WORDS / (8 * math.log(2))!r} / n_words)
        AND (word_chars < {GUARD_CHARS} OR {" + ".join(
            _divergence_sql(f"(c_{x} / word_chars)", f"(k_{x} / ({' + '.join(f'k_{y}' for y in BINS)}))") for x in BINS
        )} <= {MOST_CLASS_DIVERGENCE} + {(len(BINS) - 1) / (8 * math.log(2))!r} / word_chars) AS fits
    FROM judged j JOIN word_divergence USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, coalesce(fits, FALSE) AS kept
FROM based LEFT JOIN verdicts USING (r)
"""

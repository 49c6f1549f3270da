"""Quality rules: repetition limits, then divergence of a text from the other texts of its language.

Each text becomes two histograms: characters by class, and words by a fixed list of common words. The reference of a
language is the mean histogram of the documents of that `lang` which meet the base rules, over the whole table. A text
fails where the Jensen-Shannon distance (square root of the divergence, base 2) to its reference is above the limit.
Short texts are guarded: a histogram speaks only from a minimum of characters or words on.

Built-in functions only; texts never cross a shuffle, only a row of numbers per document does.

Cases: null text is an empty one (0 words, fails the base rule). A null `lang` is a language of its own. A language none
of whose documents meets the base rules has no reference; the base rules alone decide there. Repeated rows each get a
row. An empty table gives an empty result. Other columns are ignored by `measured` and handed through by `passing`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import SPACE_CLASS, WORDS_SQL, kept

#: Frequent words of English, French, German and Spanish: fixed values.
COMMON_WORDS = (
    "the of and to in is that it for was on with as be by this "
    "de la le et les des un que en du "
    "der die und den das ist nicht ein "
    "el los y se las por una no"
).split()
#: Classes of the character histogram between small letters and spaces: capitals, digits, stops, symbols. The last bin holds the rest.
OTHERS = ("[A-Z]", "[0-9]", "[.,;:!?'\"()-]", "[#*$%&|<>@/\\\\+=_~^`\\[\\]{}]")


@dataclass(frozen=True)
class Limits:
    min_words: int = 20
    max_repeat_percent: int = 30
    window: int = 8
    #: Largest distance of the class histogram, and the characters from which on it counts.
    class_distance: float = 0.35
    class_chars: int = 100
    #: Largest distance of the common-word histogram, and the words from which on it counts.
    word_distance: float = 0.6
    word_words: int = 60


def _let(name: str, value: str, body: str) -> str:
    """`body` with `name` bound to `value`. A lambda's argument is computed once, whereas Spark may repeat the expression
    of a column wherever the column is used, inside a lambda for every element."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _letter(i: int) -> str:
    """The letter of the i-th common word, from 0x30 on."""
    c = chr(48 + i)
    return "\\\\" if c == "\\" else c


def _repeat_words(k: int) -> str:
    """Words under windows that stand twice or more; `ws` is the array of words. A text whose windows all differ skips the sort."""
    # Hashes of 1, 2, 4, ... words in turn: each is made of two of the step before.
    windows, width = "transform(ws, w -> xxhash64(w))", 1
    while width < k:
        step = min(width, k - width)
        windows = _let(f"a{width}", windows, f"zip_with(slice(a{width}, 1, size(a{width}) - {step}), slice(a{width}, {step + 1}, size(a{width})), (x, y) -> xxhash64(x, y))")
        width += step
    twice = (
        "sort_array(transform(filter(o, (x, i) -> (i > 0 AND get(o, i - 1).h = x.h) "
        "OR (i + 1 < size(o) AND get(o, i + 1).h = x.h)), x -> x.i))"
    )
    covered = f"aggregate(transform(t, (p, i) -> coalesce(least({k}, get(t, i + 1) - p), {k})), 0, (a, x) -> a + x)"
    ordered = "sort_array(transform(hs, (h, i) -> struct(h as h, i as i)))"
    count = _let("o", ordered, _let("t", twice, covered))
    some = _let("hs", windows, f"if(size(array_distinct(hs)) = size(hs), 0, {count})")
    return f"if(size(ws) < {k}, 0, {some})"


def measured(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """doc_id, lang, the base counts and both histograms of each row."""
    common = ", ".join(f"'{w}'" for w in COMMON_WORDS)
    # One letter per common word, so that counting is a replacement in a short string.
    short = max(map(len, COMMON_WORDS))
    letters = f"transform(filter(ws, w -> length(w) <= {short} AND lower(w) IN ({common})), w -> char(array_position(array({common}), lower(w)) + 47))"
    counts = ", ".join(f"length(r) - length(replace(r, '{_letter(i)}', ''))" for i in range(len(COMMON_WORDS)))
    word_bins = _let("r", f"array_join({letters}, '')", f"array({counts})")
    by_words = f"struct(size(ws) as n_words, {_repeat_words(limits.window)} as n_repeat, {word_bins} as word_bins)"
    lines = f"filter(split(text, '\\n'), l -> l rlike '[^{SPACE_CLASS[1:]}')"
    # Small letters and blanks, nearly all of a text, are counted in one pass; the other classes in what is left.
    blanks = F.expr("char_length(text) - char_length(replace(text, ' ', ''))")
    df = docs.select("doc_id", F.coalesce("lang", F.lit("\0")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    df = df.select(
        "doc_id",
        "lang",
        F.expr(_let("ws", WORDS_SQL, by_words)).alias("m"),
        F.expr(_let("ls", lines, "size(ls) - size(array_distinct(ls))")).cast("long").alias("n_dup_lines"),
        F.char_length("text").alias("n_chars"),
        blanks.alias("n_blanks"),
        F.regexp_replace("text", "[a-z ]+", "").alias("rest"),
    )

    def count(pattern: str) -> Column:
        return F.char_length("rest") - F.char_length(F.regexp_replace("rest", pattern, ""))

    lowers = F.col("n_chars") - F.col("n_blanks") - F.char_length("rest")
    df = df.select(
        "*",
        count("[#*$%&|<>]").cast("long").alias("n_symbols"),
        F.array(lowers, *[count(p) for p in OTHERS], count("[\\x09-\\x0D]") + F.col("n_blanks")).alias("bins"),
    )
    rest = "concat({0}, array(cast({1} as int) - aggregate({0}, 0, (a, x) -> a + x)))"
    df = df.select(
        "doc_id",
        "lang",
        F.col("m.n_words").cast("long").alias("n_words"),
        (F.col("n_chars") - F.element_at("bins", -1)).cast("long").alias("word_chars"),
        "n_symbols",
        "n_dup_lines",
        F.col("m.n_repeat").cast("long").alias("n_repeat_words"),
        F.col("n_chars").cast("long").alias("n_chars"),
        F.expr(rest.format("bins", "n_chars")).alias("class_bins"),
        F.expr(rest.format("m.word_bins", "m.n_words")).alias("word_bins"),
    )
    failed = (F.col("n_words") < limits.min_words) | (100 * F.col("n_repeat_words") > limits.max_repeat_percent * F.col("n_words"))
    return df.withColumn("base_failed", failed)


def references(rows: DataFrame) -> DataFrame:
    """One row per language: mean share of each bin over the documents that meet the base rules."""

    def means(name: str, n: int, total: str) -> Column:
        return F.array(*[F.avg(F.col(name)[i] / F.col(total)) for i in range(n)])

    good = rows.where(~F.col("base_failed"))
    return good.groupBy("lang").agg(
        means("class_bins", 7, "n_chars").alias("class_mean"),
        means("word_bins", len(COMMON_WORDS) + 1, "n_words").alias("word_mean"),
    )


def _distance(bins: str, total: str, mean: str) -> Column:
    """Jensen-Shannon distance, base 2, between a document's shares and a mean."""
    part = "if({0} > 0, {0} * log2({0} / (({1} + {2}) / 2)), 0D)"
    p, q = f"(c / {total})", "m"
    one = part.format(p, p, q) + " + " + part.format(q, p, q)
    total_sum = f"aggregate(zip_with({bins}, {mean}, (c, m) -> {one}), 0D, (a, x) -> a + x) / 2"
    return F.sqrt(F.greatest(F.lit(0.0), F.expr(total_sum)))


def judged(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Counts, base verdict, both distances (null where the guard holds) and `kept`, a row per document row.

    The reference of a language is a small table; whether it is broadcast is left to Spark, which knows its size, as
    it is read back from storage. Beyond the threshold the rows of numbers are joined by a shuffle, split where skewed.
    """
    rows = kept(measured(docs, limits), "quality-rows")
    means = kept(references(rows), "quality-means")
    df = rows.join(means, "lang", "left")
    class_d = F.when(F.col("n_chars") >= limits.class_chars, _distance("class_bins", "n_chars", "class_mean"))
    word_d = F.when(F.col("n_words") >= limits.word_words, _distance("word_bins", "n_words", "word_mean"))
    df = df.withColumn("class_distance", class_d).withColumn("word_distance", word_d)
    near = (F.coalesce("class_distance", F.lit(0.0)) <= limits.class_distance) & (
        F.coalesce("word_distance", F.lit(0.0)) <= limits.word_distance
    )
    return df.withColumn("kept", ~F.col("base_failed") & near)


def passing(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The documents that the rules keep, all columns. A document id decides: rows that share an id stand or fall together."""
    bad = kept(judged(docs, limits).where(~F.col("kept")).select("doc_id").distinct(), "quality-bad")
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["doc_id"]), "left_anti").select(*docs.columns)

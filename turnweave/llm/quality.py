"""Quality rules by distribution divergence, in DataFrame functions only.

A document's histogram of character classes and its histogram of common words of its language are compared
with that language's references by the Jensen-Shannon distance (square root of the divergence to base 2, 0 to
1). A document is rejected by this method if either distance is over its threshold and the document is long
enough for the histogram to mean something. References are pooled from labelled rows of good quality.

Within a row everything is a higher-order function over the row's own words, so there is no shuffle and the
memory of a task is that of its longest text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

#: Common words of each language that has references. Fixed values.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "a", "in", "is", "it", "that", "for", "with", "on", "by", "this", "from", "as"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "une", "du", "que", "qui", "est", "dans", "pour", "par"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "nicht"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "del", "se", "las", "por", "un", "para", "con", "no"],
}
#: Labelled rows from which the references are fitted, at most.
FIT_ROWS = 4_000
#: Distances over these reject, from so many characters or words on.
MAX_CLASS_DISTANCE = 0.30
# Of labelled good rows of sf0.1 the word distance is 0.308 at most; without any common word it is 0.325 or more.
MAX_WORD_DISTANCE = 0.31
MIN_CHARS = 200
MIN_WORDS = 50

CLASSES = ("lower", "upper", "digit", "space", "symbol", "beyond", "other")
_SPACE = r"[\x20\x09-\x0D]"


def _only(text: Column, inside: str) -> Column:
    """How many characters of ``text`` belong to a class."""
    return F.length(F.regexp_replace(text, f"[^{inside}]+", ""))


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, f"{_SPACE}+"), "")


def _repeat_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more."""

    def covered(windows: Column) -> Column:
        pairs = F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))

        def again(s: Column) -> Column:
            same = lambda a, b: F.coalesce(F.get(s, a)["x"] == F.get(s, b)["x"], F.lit(False))
            places = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda k: same(k, k - 1) | same(k, k + 1))
            three = F.transform(places, lambda k: let(F.get(s, k)["i"], lambda i: F.array(i, i + 1, i + 2)))
            return F.size(F.array_distinct(F.flatten(three)))

        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(let(pairs, again))

    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) < 4, F.lit(0)).otherwise(let(windows, covered))


def measures(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``df`` with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, char_hist, word_hist``.

    A null text has no words. Windows are compared by 64-bit hashes. ``word_hist`` counts the common words of the
    row's language and then all others; it is null for a language without a list.

    The results come out of a generator of one row: a filter on them would otherwise be pushed below and compute
    them again at each of their uses.
    """
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "char_hist", "word_hist")
    return _base(_histograms(df, text, lang)).select(*df.columns, F.inline(F.array(F.struct(*names))))


def _histograms(df: DataFrame, text: str, lang: str) -> DataFrame:
    t = F.coalesce(F.col(text), F.lit(""))
    listed = F.lit(None).cast("array<string>")
    for name, words in COMMON_WORDS.items():
        listed = F.when(F.col(lang) == name, F.array(*map(F.lit, words))).otherwise(listed)

    def counts(common: Column) -> Column:
        found = F.filter(F.col("__words"), lambda w: F.array_contains(common, w))
        return let(found, lambda f: F.concat(F.transform(common, lambda v: F.size(F.filter(f, lambda w: w == v)).cast("long")), F.array((F.size("__words") - F.size(f)).cast("long"))))

    out = df.withColumn("__text", t).withColumn("__words", _words(t))
    out = out.withColumn("n_words", F.size("__words").cast("long")).withColumn("word_chars", F.length(F.array_join("__words", "")).cast("long"))
    total = F.length("__text")
    lower, upper, digit = _only(F.col("__text"), "a-z"), _only(F.col("__text"), "A-Z"), _only(F.col("__text"), "0-9")
    out = out.withColumn("n_symbols", _only(F.col("__text"), "#*$%&|<>").cast("long"))
    out = out.withColumn("__h", F.array(lower, upper, digit, total - F.col("word_chars").cast("int"), F.col("n_symbols").cast("int"), F.length(F.regexp_replace("__text", r"[\x00-\x7F]+", ""))))
    other = total - F.aggregate("__h", F.lit(0), lambda a, x: a + x)
    return out.withColumn("char_hist", F.concat("__h", F.array(other)).cast("array<long>")).withColumn("word_hist", let(listed, counts)).drop("__h")


def _base(df: DataFrame) -> DataFrame:
    lines = F.filter(F.split("__text", "\n"), lambda x: F.length(F.translate(x, " \t\n\x0b\f\r", "")) > 0)
    repeated_lines = let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    return df.withColumn("n_dup_lines", repeated_lines.cast("long")).withColumn("n_repeat_words", _repeat_words(F.col("__words")).cast("long")).drop("__words", "__text")


def js_distance(counts: Column, reference: list[float]) -> Column:
    """Jensen-Shannon distance between counts and reference shares (null if there is nothing to compare)."""

    def distance(total: Column) -> Column:
        terms = None
        for k, q in enumerate(reference):
            p = F.get(counts, F.lit(k)) / total
            m = (p + q) / 2
            term = F.when(p > 0, p * F.log2(p / m)).otherwise(0.0)
            if q > 0:
                term = term + q * F.log2(F.lit(q) / m)
            terms = term if terms is None else terms + term
        return F.sqrt(F.greatest(terms / 2, F.lit(0.0)))

    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    return let(total, lambda n: F.when(n > 0, distance(n.cast("double"))))


def fit_references(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", rows: int = FIT_ROWS) -> dict[str, tuple[list[float], list[float]]]:
    """Language to (shares of character classes, shares of common words), pooled over labelled good rows.

    At most ``rows`` labelled rows are used, those with the smallest hash of the key. A language without any has
    no references, and its documents pass.
    """
    good = labels.where("quality = 1 and toxic = 0").select(key).where(F.col(key).isNotNull()).distinct()
    good = good.orderBy(F.xxhash64(key), key).limit(rows)
    some = df.select(key, text, lang).where(F.col(lang).isin(*COMMON_WORDS)).join(F.broadcast(good), key, "left_semi")
    hist = _histograms(some, text, lang).select(lang, "char_hist", "word_hist")
    n_words = max(map(len, COMMON_WORDS.values())) + 1
    sums = [F.sum(F.get("char_hist", F.lit(k))).alias(f"c{k}") for k in range(len(CLASSES))] + [F.sum(F.get("word_hist", F.lit(k))).alias(f"w{k}") for k in range(n_words)]
    out = {}
    for r in hist.groupBy(lang).agg(*sums).collect():  # a row for each listed language
        chars = [r[f"c{k}"] or 0 for k in range(len(CLASSES))]
        words = [r[f"w{k}"] or 0 for k in range(len(COMMON_WORDS[r[lang]]) + 1)]
        if sum(chars) and sum(words):
            out[r[lang]] = ([x / sum(chars) for x in chars], [x / sum(words) for x in words])
    return out


def quality_rules(df: DataFrame, references: dict[str, tuple[list[float], list[float]]], text: str = "text", lang: str = "lang", max_class: float = MAX_CLASS_DISTANCE, max_word: float = MAX_WORD_DISTANCE, min_chars: int = MIN_CHARS, min_words: int = MIN_WORDS) -> DataFrame:
    """``df`` with its measures, ``class_distance, word_distance, base_failed, kept``.

    ``base_failed``: fewer than 50 words, or over half of the words in repeated three-word windows. ``kept`` is
    false if that fails, else it is the divergence's verdict. A null or unknown language, or a text under the
    minimum lengths, has no distance and passes. Repeated rows are judged each; columns of ``df`` that have the
    name of a result are replaced.
    """
    clash = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "char_hist", "word_hist", "class_distance", "word_distance", "base_failed", "kept")
    out = measures(df.drop(*clash), text, lang)
    by_class = by_word = F.lit(None).cast("double")
    for name, (chars, words) in sorted(references.items()):
        of = F.col(lang) == name
        by_class = F.when(of, js_distance(F.col("char_hist"), chars)).otherwise(by_class)
        by_word = F.when(of, js_distance(F.col("word_hist"), words)).otherwise(by_word)
    out = out.withColumn("class_distance", F.when(F.aggregate("char_hist", F.lit(0).cast("long"), lambda a, x: a + x) >= min_chars, by_class))
    out = out.withColumn("word_distance", F.when(F.col("n_words") >= min_words, by_word))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    diverges = F.coalesce(F.col("class_distance") > max_class, F.lit(False)) | F.coalesce(F.col("word_distance") > max_word, F.lit(False))
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & ~diverges)

"""Quality rules (8): a threshold table compiled into one Spark projection.

Every metric is a built-in column expression and every rule a comparison with
its bounds, so a whole rule set is one ``select`` without user functions, joins
or shuffles.

Defined results:
* null or empty text, or text of white space only: no words, all counts 0,
  ``base_failed`` and not ``kept``.
* ratios whose denominator is 0 are null; a null ratio fails no rule.
* repeated rows are judged one by one; an empty table gives an empty result;
  columns other than the text play no part and may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, words

SYMBOLS = "#*$%&|<>"

# Frequent function words of English, German, French, Spanish.
STOP_WORDS = tuple(
    "the of and to in is that it for was on are as with at be this have from or a an "
    "der die das und ist zu den mit von ein eine nicht sich auf des dem im "
    "le la les de et en un une du que qui dans pour par sur au avec est "
    "el los las y es por con para del se lo como su".split())


@dataclass(frozen=True)
class Rule:
    """``low <= metric <= high``; a bound of None does not apply."""
    name: str
    metric: str
    low: float | None = None
    high: float | None = None


# The method's own rules, beside the two base rules of ``BASE_RULES``.
RULES = (
    Rule("mean_word_length", "mean_word_length", 3.0, 10.0),
    Rule("symbol_ratio", "symbol_ratio", None, 0.1),
    Rule("stop_word_ratio", "stop_word_ratio", 0.05, None),
    Rule("duplicate_line_ratio", "dup_line_ratio", None, 0.4),
    Rule("capital_ratio", "capital_ratio", None, 0.5),
)
BASE_RULES = (
    Rule("min_words", "n_words", 50, None),
    Rule("repeated_words", "repeat_percent", None, 50),
)


def _repeat_words(ws: Column) -> Column:
    """Words standing in a 3-word window that occurs twice or more.

    Equal windows have equal hashes, so all-distinct hashes prove that nothing
    repeats; only the other texts sort their windows (as text, so exactly).
    """
    starts = F.slice(ws, F.lit(1), F.greatest(F.size(ws) - 2, F.lit(0)))
    hashes = F.transform(starts, lambda w, i: F.xxhash64(w, F.get(ws, i + 1), F.get(ws, i + 2)))
    windows = F.array_sort(F.transform(starts, lambda w, i: F.struct(
        F.concat_ws(" ", w, F.get(ws, i + 1), F.get(ws, i + 2)).alias("w"), i.alias("i"))))

    def count(sorted_windows: Column) -> Column:
        again = F.filter(sorted_windows, lambda x, k: F.coalesce(
            (F.get(sorted_windows, k - 1)["w"] == x["w"])
            | (F.get(sorted_windows, k + 1)["w"] == x["w"]),
            F.get(sorted_windows, k - 1)["w"] == x["w"],
            F.get(sorted_windows, k + 1)["w"] == x["w"], F.lit(False)))
        at = F.array_sort(F.transform(again, lambda x: x["i"]))
        # Each repeated window adds the words up to the next repeated window, 3 at most.
        return let(at, lambda p: F.aggregate(
            F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3)))),
            F.lit(0), lambda a, x: a + x))

    return F.when(let(hashes, lambda h: F.size(F.array_distinct(h)) == F.size(h)), F.lit(0)) \
        .otherwise(let(windows, count))


def metrics(text: Column) -> dict[str, Column]:
    """Count metrics of a text as columns (first level of the projection)."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.length(F.btrim(x, F.lit(" \t\x0b\x0c\r"))) > 0)

    def of_words(ws: Column) -> Column:
        return F.struct(
            F.size(ws).cast("long").alias("n_words"),
            _repeat_words(ws).cast("long").alias("n_repeat_words"),
            F.size(F.filter(ws, lambda w: F.lower(w).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"))

    counted = let(words(t), of_words)
    counted_lines = let(lines, lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"),
        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    return {
        "by_word": counted,
        "by_line": counted_lines,
        "word_chars": (F.length(t) - F.regexp_count(t, F.lit(r"[\x20\x09-\x0D]"))).cast("long"),
        "n_symbols": F.regexp_count(t, F.lit("[" + SYMBOLS + "]")).cast("long"),
        "n_capitals": F.regexp_count(t, F.lit("[A-Z]")).cast("long"),
    }


def _ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def _holds(rule: Rule, value: Column) -> Column:
    parts = [value >= rule.low] if rule.low is not None else []
    parts += [value <= rule.high] if rule.high is not None else []
    out = F.lit(True)
    for p in parts:
        out = out & F.coalesce(p, F.lit(True))
    return out


def assess(text: Column, rules: tuple[Rule, ...] = RULES,
           base_rules: tuple[Rule, ...] = BASE_RULES) -> Column:
    """One struct per text: counts, ratios, ``failed`` rule names, verdicts."""
    def judged(m: Column) -> Column:
        c = {k: m["by_word"][k] for k in ("n_words", "n_repeat_words", "n_stop_words")}
        c |= {k: m["by_line"][k] for k in ("n_lines", "n_dup_lines")}
        c |= {k: m[k] for k in ("word_chars", "n_symbols", "n_capitals")}
        c["mean_word_length"] = _ratio(c["word_chars"], c["n_words"])
        c["symbol_ratio"] = _ratio(c["n_symbols"], c["n_words"])
        c["stop_word_ratio"] = _ratio(c["n_stop_words"], c["n_words"])
        c["dup_line_ratio"] = _ratio(c["n_dup_lines"], c["n_lines"])
        c["capital_ratio"] = _ratio(c["n_capitals"], c["word_chars"])
        c["repeat_percent"] = _ratio(100 * c["n_repeat_words"], c["n_words"])
        failed_base = F.array_compact(F.array(*[
            F.when(~_holds(r, c[r.metric]), F.lit(r.name)) for r in base_rules]))
        failed = F.array_compact(F.array(*[
            F.when(~_holds(r, c[r.metric]), F.lit(r.name)) for r in rules]))
        return F.struct(*[v.alias(k) for k, v in c.items()],
                        (F.size(failed_base) > 0).alias("base_failed"),
                        F.concat(failed_base, failed).alias("failed"),
                        (F.size(failed_base) + F.size(failed) == 0).alias("kept"))

    return let(F.struct(*[v.alias(k) for k, v in metrics(text).items()]), judged)


def quality(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a struct column ``quality`` (see ``assess``)."""
    return docs.withColumn("quality", assess(F.col(text)))


def filter_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that pass every rule, columns unchanged."""
    return docs.filter(assess(F.col(text))["kept"])

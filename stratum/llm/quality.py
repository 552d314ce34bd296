"""Quality rules: a threshold table compiled into one projection of text statistics.

The statistics and the rules are plain column expressions, so Spark runs the scan,
the statistics and the verdict in one narrow stage: no shuffle, no user function.

Defined results: null and empty text have no words and fail ``min_words``; ratios of a
text without words or lines are 0; repeated rows are judged one by one; the input's
other columns are never read, so their names cannot clash. Windows of words are compared
by a chained 64-bit hash of the eight words within one text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.text import SPACE, let, whole, words

WINDOW = 8
SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 20
MAX_REPEAT_PCT = 30

# fixed values: frequent function words of the four languages of the corpus
STOP_WORDS = (
    "the be to of and that have with this in is was for on are as at by from it or an a "
    "der die das und ist in den von zu mit nicht ein eine auf für im dem des sich "
    "le la les de et un une du dans est pour que qui sur par au aux pas "
    "el los las y en por con del se es una su al lo como"
).split()


@dataclass(frozen=True)
class Rule:
    """``low <= metric <= high``; a None bound is open."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None

    def passes(self, metrics: dict[str, Column]) -> Column:
        value = metrics[self.metric]
        ok = F.lit(True)
        if self.low is not None:
            ok = ok & (value >= F.lit(float(self.low)))
        if self.high is not None:
            ok = ok & (value <= F.lit(float(self.high)))
        return ok


RULES = (
    Rule("word_length", "mean_word_length", 2, 14),
    Rule("symbols", "symbol_ratio", high=0.1),
    Rule("stop_words", "stop_word_ratio", low=0.02),
    Rule("duplicate_lines", "duplicate_line_ratio", high=0.5),
    Rule("bullet_lines", "bullet_line_ratio", high=0.9),
    Rule("ellipsis_lines", "ellipsis_line_ratio", high=0.3),
)


def _repeated(windows: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more."""
    ordered = F.array_sort(F.transform(
        windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def positions(s: Column) -> Column:
        same = lambda k, j: F.coalesce(F.get(s, j)["h"] == F.get(s, k)["h"], F.lit(False))
        hits = F.filter(F.sequence(F.lit(0), F.size(s) - 1),
                        lambda k: same(k, k - 1) | same(k, k + 1))
        return F.sort_array(F.transform(hits, lambda k: F.get(s, k)["i"]))

    covered = F.aggregate(
        let(ordered, positions),
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda acc, p: F.struct(
            p.alias("last"),
            (acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n")),
        lambda acc: acc["n"])
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), covered).otherwise(0)


def measured(text: Column) -> Column:
    """A struct of all counts (longs) of a text, as one expression.

    Words, lines and windows are bound once by ``let``, so that the expression stays small
    and is evaluated once wherever the optimizer moves it, also into a filter.
    """
    trimmed = lambda l: F.btrim(l, F.lit(SPACE))
    stop = [*dict.fromkeys(STOP_WORDS)]

    def parts(t: Column) -> Column:
        return F.struct(t.alias("t"), words(t).alias("w"),
                        F.filter(F.split(t, "\n"), lambda l: trimmed(l) != "").alias("l"))

    def windows(w: Column) -> Column:
        return F.when(F.size(w) >= WINDOW, F.transform(
            F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(w, i, WINDOW)))
        ).otherwise(F.array().cast("array<bigint>"))

    def counts(x: Column) -> Column:
        t, w, l = x["t"], x["w"], x["l"]
        named = {
            "n_words": F.size(w),
            "word_chars": F.length(F.array_join(w, "")),
            "n_symbols": F.regexp_count(t, F.lit(SYMBOLS)),
            "n_dup_lines": F.size(l) - F.size(F.array_distinct(l)),
            "n_repeat_words": let(windows(w), _repeated),
            "n_lines": F.size(l),
            "n_stop_words": F.size(F.filter(w, lambda v: F.lower(v).isin(stop))),
            "n_bullet_lines": F.size(F.filter(l, lambda v: trimmed(v).rlike(r"^[-*•‣▪]"))),
            "n_ellipsis_lines": F.size(F.filter(l, lambda v: trimmed(v).rlike(r"(\.\.\.|…)$"))),
        }
        return F.struct(*[c.cast("long").alias(n) for n, c in named.items()])

    return let(let(whole(text), parts), counts)


def metrics(m: Column) -> dict[str, Column]:
    """The ratios that rules may name, over a struct of counts."""
    ratio = lambda a, b: m[a] / F.greatest(m[b], F.lit(1)).cast("double")
    return {
        "n_words": m["n_words"].cast("double"),
        "mean_word_length": ratio("word_chars", "n_words"),
        "symbol_ratio": ratio("n_symbols", "n_words"),
        "stop_word_ratio": ratio("n_stop_words", "n_words"),
        "duplicate_line_ratio": ratio("n_dup_lines", "n_lines"),
        "bullet_line_ratio": ratio("n_bullet_lines", "n_lines"),
        "ellipsis_line_ratio": ratio("n_ellipsis_lines", "n_lines"),
    }


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PCT * m["n_words"])


def failed_rules(m: Column, rules: tuple[Rule, ...]) -> Column:
    """Names of the rules that a struct of counts fails, comma-joined."""
    values = metrics(m)
    return F.concat_ws(",", *[F.when(~r.passes(values), F.lit(r.name)) for r in rules])


def kept(m: Column, rules: tuple[Rule, ...]) -> Column:
    return ~base_failed(m) & (failed_rules(m, rules) == "")


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
          text: str = "text") -> DataFrame:
    """(id, counts, ``base_failed``, ``failed_rules``, ``kept``) per row."""
    m = F.col("m")
    return docs.select(F.col(id_col), measured(F.col(text)).alias("m")).select(
        id_col, "m.*", base_failed(m).alias("base_failed"), failed_rules(m, rules).alias("failed_rules"),
        kept(m, rules).alias("kept"))


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """Rows of ``docs`` that every rule passes, with all their columns, in one narrow stage."""
    return docs.filter(let(measured(F.col(text)), lambda m: kept(m, rules)))

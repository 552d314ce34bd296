"""Secret scans: spans of credential-like strings, and corpus-wide ownership of their values.

Spans are found per row by built-in regular expression functions: the gaps between matches
(``split``) and the matches themselves give every start and end, in code points. Values
are hashed at once; only hashes leave the row. Ownership is aggregated over the corpus:
(value, owner, repository) is made distinct before counting, so a value that a third of
all rows contain is combined in its tasks and arrives once per task. A value held by
``min_owners`` or more owners is a copied example; one that names itself a placeholder is
an example too, but never a private key, whose body holds any word by chance; the rest is
owner-specific and treated as live. A span's numbers of owners and repositories are both
returned: many repositories of one owner still are that owner's credential.

Defined results: null, empty and very long texts are scanned whole, and spans have no
greatest length; null and empty texts have no spans; a null owner or repository counts as
one unnamed owner or repository; repeated rows are judged alike; spans of one kind never
overlap, spans of different kinds may; an empty table gives no rows; the input's other
columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.text import fold_list, let, whole
from stratum.operators.joins import sized_broadcast

MIN_OWNERS = 3
PLACEHOLDER = "[SECRET]"


@dataclass(frozen=True)
class Kind:
    """A pattern; ``group`` is the secret value, which needs ``least`` characters. ``words``: placeholder words count."""

    name: str
    pattern: str
    group: int = 0
    least: int = 1
    words: bool = True


# fixed values: kinds of the base scan, in their order
BASE = (
    Kind("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    Kind("access", r"AKIA[A-Z0-9]{16,}"),
    Kind("hex", r"[0-9a-f]{24,}"),
)
# Repeated groups are possessive, so that a match of any length takes no stack.
# lines of base64, parted by line ends as written, escaped or quoted
_GAP = r"""[\t\n\r \\"'+,>#*]"""
_LINES = rf"[A-Za-z0-9+/]{{16,}}+(?:{_GAP}++[A-Za-z0-9+/]{{16,}}+)*+(?:{_GAP}++[A-Za-z0-9+/]{{1,15}}+)?={{0,2}}"
# a key block: to its end mark, or to the end of its lines where there is none; the value is all after the header
PEM = (r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----"
       r"((?:[^-]++|-{1,4}+(?!-))*+-----END [A-Z0-9 ]*PRIVATE KEY-----"
       rf"|{_GAP}*+(?:[nr]{_GAP}*+)?(?:[A-Za-z-]++: [^\n]*+\n[\n\r\t ]*+)*+{_LINES})")
# published formats of issued keys
ISSUED = (
    Kind("issued", r"(?:gh[pousr]_|github_pat_|glpat-|sk_live_|rk_live_|xox[abprs]-|AIza)[A-Za-z0-9_-]{16,}"),
    Kind("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Kind("pem", PEM, 1, 16, words=False),
    Kind("url", r"://[^\x09-\x0D\x20:/@]++:([^\x09-\x0D\x20:/@]{3,}+)@", 1),
)
KINDS = BASE + ISSUED
SPAN = "struct<start:int,kind:int,end:int,hash:string,example:boolean>"
FOUND = "struct<start:int,kind:int,end:int,live:boolean,owners:bigint,repos:bigint>"
# fixed values: words by which a value names itself an example
_WORDS = r"(^|[^a-z])(example|sample|dummy|placeholder|changeme|redacted|x{4,}|your)([^a-z]|$)"


def _example(value: Column, kind: Kind) -> Column:
    """Values that name themselves an example, or hardly vary."""
    low = F.lower(value)
    few = F.size(F.array_distinct(F.split(low, ""))) <= 4
    return low.rlike(_WORDS) | few if kind.words else F.lit(False)


def _spans_of(text: Column, rank: int, kind: Kind) -> Column:
    """Leftmost non-overlapping matches as an array of spans."""
    pattern = F.lit(kind.pattern)
    none = F.array().cast(f"array<{SPAN}>")

    def walk(parts: Column) -> Column:
        def step(at: Column, k: Column) -> tuple[Column, Column]:
            start = at + F.length(F.get(parts["gaps"], k))
            end = start + F.length(F.get(parts["found"], k))
            value = F.get(parts["values"], k)
            span = F.struct(start.alias("start"), F.lit(rank).alias("kind"), end.alias("end"),
                            F.sha2(value, 256).alias("hash"), _example(value, kind).alias("example"))
            return end, F.when(F.length(value) >= kind.least, F.array(span)).otherwise(none)

        return fold_list(F.size(parts["found"]), F.lit(0), step, SPAN)["out"]

    parts = F.struct(F.split(text, kind.pattern, -1).alias("gaps"),
                     F.regexp_extract_all(text, pattern, 0).alias("found"),
                     F.regexp_extract_all(text, pattern, kind.group).alias("values"))
    return F.when(text.rlike(kind.pattern), let(parts, walk)).otherwise(none)


def spans(text: Column, kinds: tuple[Kind, ...] = KINDS) -> Column:
    """All spans of a non-null text, by start and then kind."""
    return F.array_sort(F.concat(*[_spans_of(text, i, k) for i, k in enumerate(kinds)]))


def scan(docs: DataFrame, id_col: str, text: str, owner: str, repository: list[str]) -> DataFrame:
    """(row, id, owner, repo, spans) per row; checkpointed, as several passes read it."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), name(owner).alias("owner"),
        F.to_json(F.array(*[name(c) for c in repository])).alias("repo"),
        F.xxhash64(whole(F.col(text))).alias("text_hash"), whole(F.col(text)).alias("t"),
    ).select("row", "id", "owner", "repo", "text_hash", spans(F.col("t")).alias("spans")).checkpoint()


def ownership(found: DataFrame) -> DataFrame:
    """(hash, n_owners, n_repos) over every candidate of the corpus."""
    held = found.select("owner", "repo", F.explode("spans").alias("s")).select(
        F.col("s.hash").alias("hash"), "owner", "repo").distinct()
    by_owner = held.groupBy("hash", "owner").agg(F.count("*").alias("n"))
    return by_owner.groupBy("hash").agg(F.count("*").alias("n_owners"), F.sum("n").alias("n_repos"))


def judged(found: DataFrame, min_owners: int = MIN_OWNERS) -> DataFrame:
    """(row, judged array of spans with their verdicts, owners and repositories) of rows with candidates."""
    held = ownership(found).withColumnRenamed("hash", "held")
    each = found.select("row", F.explode("spans").alias("s"))
    each = each.join(held, each["s"]["hash"] == held["held"])
    live = (F.col("n_owners") < min_owners) & ~F.col("s.example")
    span = F.struct("s.start", "s.kind", "s.end", live.alias("live"), F.col("n_owners").alias("owners"),
                    F.col("n_repos").alias("repos"))
    return each.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("judged"))


def _names(kinds: tuple[Kind, ...]) -> Column:
    return F.array(*[F.lit(k.name) for k in kinds])


def joined(array: Column, kinds: tuple[Kind, ...] = KINDS) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(array, lambda s: F.concat_ws(
        ":", F.get(_names(kinds), s["kind"]), s["start"], s["end"])), ",")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text: str = "text", owner: str = "source",
                 repository: tuple[str, ...] = ("source", "lang"), min_owners: int = MIN_OWNERS) -> DataFrame:
    """One row per input row: counts and digest of the base kinds, all spans, and the verdict.

    ``held_by`` gives each span's owners/repositories, in the order of ``spans``.
    """
    found = scan(docs, id_col, text, owner, list(repository))
    verdict = judged(found, min_owners)
    n = lambda i: F.size(F.filter("spans", lambda s: s["kind"] == i)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    rows = found.select(
        "row", F.col("id").alias(id_col), *[n(i).alias(f"n_{k.name}") for i, k in enumerate(BASE)],
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
    all_ = F.coalesce("judged", F.array().cast(f"array<{FOUND}>"))
    live = F.filter(all_, lambda s: s["live"])
    return rows.join(verdict, "row", "left").select(
        id_col, *[f"n_{k.name}" for k in BASE], "base_sha256", "spans",
        joined(live).alias("live_spans"), F.size(live).cast("long").alias("n_live"),
        (F.size(all_) - F.size(live)).cast("long").alias("n_copied"),
        F.array_join(F.transform(all_, lambda s: F.concat_ws("/", s["owners"], s["repos"])), ",").alias("held_by"))


def _covered(live: Column) -> Column:
    """Sorted spans merged into disjoint (start, end)."""
    kind = "struct<start:int,end:int>"
    none = F.array().cast(f"array<{kind}>")

    def step(last: Column, k: Column) -> tuple[Column, Column]:
        own = F.struct(F.get(live, k)["start"].alias("start"), F.get(live, k)["end"].alias("end"))
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], own["end"]).alias("end"))
        apart = last.isNull() | (own["start"] > last["end"])
        return (F.when(apart, own).otherwise(longer),
                F.when(apart & last.isNotNull(), F.array(last)).otherwise(none))

    merged = fold_list(F.size(live), F.lit(None).cast(kind), step, kind)
    return let(merged, lambda m: F.when(m["at"].isNull(), m["out"]).otherwise(F.concat(m["out"], F.array(m["at"]))))


def redacted(text: Column, live: Column, placeholder: str = PLACEHOLDER) -> Column:
    """``text`` with the merged spans replaced.

    Slices are taken from a fixed-width encoding, so their cost does not depend on their
    place; a leading space keeps a slice's first character from being read as a byte order mark.
    """
    def rebuild(x: Column) -> Column:
        cuts, wide = x["cuts"], x["wide"]

        def slice_(start: Column, end: Column) -> Column:
            part = F.concat(F.encode(F.lit(" "), "UTF-32"), F.substring(wide, start * 4 + 1, (end - start) * 4))
            return F.substring(F.decode(part, "UTF-32"), F.lit(2), F.length(part))

        gaps = F.transform(F.sequence(F.lit(0), F.size(cuts)), lambda k: slice_(
            F.coalesce(F.get(cuts, k - 1)["end"], F.lit(0)),
            F.coalesce(F.get(cuts, k)["start"], (F.length(wide) / 4).cast("int"))))
        return F.array_join(gaps, placeholder)

    return let(F.struct(_covered(live).alias("cuts"), F.encode(text, "UTF-32").alias("wide")), rebuild)


def redact(docs: DataFrame, id_col: str = "doc_id", text: str = "text", owner: str = "source",
           repository: tuple[str, ...] = ("source", "lang"), min_owners: int = MIN_OWNERS) -> DataFrame:
    """``docs`` with live secrets replaced; every row stays, with all its columns.

    The spans to replace are joined by id and text hash, so rows that repeat an id keep
    their own spans; within the broadcast bound the texts are not shuffled for it.
    """
    found = scan(docs, id_col, text, owner, list(repository))
    found_live = F.filter("judged", lambda s: s["live"])
    live = (found.join(judged(found, min_owners), "row").withColumn("live", found_live).filter(F.size("live") > 0)
            .groupBy("id", "text_hash").agg(F.first("live").alias("live")).checkpoint())
    rows = docs.select(F.struct("*").alias("_r"), F.col(id_col).alias("_id"),
                       F.xxhash64(whole(F.col(text))).alias("_h"))
    live = sized_broadcast(live)
    out = rows.join(live, F.col("_id").eqNullSafe(live["id"]) & (F.col("_h") == live["text_hash"]), "left")
    new = F.when(F.col("live").isNull(), F.col("_r")[text]).otherwise(redacted(F.col("_r")[text], F.col("live")))
    return out.select(*[new.alias(c) if c == text else F.col("_r")[c].alias(c) for c in docs.columns])

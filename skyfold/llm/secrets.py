"""Secret scans over an incremental ledger of blobs.

Every version of a text is addressed by the hash of its content. The ledger
keeps which blobs were scanned under which version of which rule, and what was
found; a scan looks only at pairs of blob and rule version that it doesn't hold,
at one copy of a blob, and joins findings back to every path that has it.
Everything is DataFrame expressions.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import stage


class Rule(NamedTuple):
    """``group`` (if any) must have ``least`` characters; ``hint``, in lower case,
    stands in every text the pattern can match, in any case."""
    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0
    hint: str = ""

    @property
    def tag(self) -> str:
        return f"{self.kind}/{self.version}"


#: fixed values: the base kinds in their order, then formats of tokens that services document.
#: Nothing repeats but single characters, and what is looked for again from many places has a
#: bound: other patterns overflow the stack, or take quadratic time, on hostile texts
BASE = [
    Rule("assign", 1, r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20, "akia"),
    Rule("hex", 1, r"[0-9a-f]{24,}"),
]
EXTRA = [
    Rule("private_key", 2, r"-----BEGIN [A-Z ]{0,64}PRIVATE KEY-----", hint="private key-----"),
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", hint="gh"),
    Rule("slack", 1, r"xox[abprs]-[A-Za-z0-9-]{10,}", hint="xox"),
    Rule("jwt", 2, r"eyJ[A-Za-z0-9_-]{10,1000}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", hint="eyj"),
    Rule("google", 1, r"AIza[A-Za-z0-9_-]{35}", hint="aiza"),
]
RULES = [*BASE, *EXTRA]
#: matches of a text whose places are listed at a time
RUN = 256

_SPANS = "array<struct<start:long,at:int,kind:string,end:long>>"


def spans(text: Column, rule: Rule, at: int) -> Column:
    """All spans of a rule: leftmost, non-overlapping, in code points, end exclusive.

    The text between matches and the matches alternate, so their lengths add up
    to the positions.
    """
    pattern = F.lit(rule.pattern)
    hit = text.rlike(rule.pattern)
    if rule.hint:
        hit = F.lower(text).contains(rule.hint) & hit
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    kept = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    pieces = F.arrays_zip(F.slice(F.split(text, rule.pattern, -1), 1, F.size(found)).alias("gap"),
                          found.alias("match"), kept.alias("kept"))
    lengths = F.transform(pieces, lambda p: F.struct(F.length(p["gap"]).alias("gap"), F.length(p["match"]).alias("match"),
                                                     (F.length(p["kept"]) >= rule.least).alias("ok")))
    none = F.array().cast(_SPANS)

    def step(state: Column, piece: Column) -> Column:
        begin = state["pos"] + piece["gap"]
        end = begin + piece["match"]
        span = F.struct(begin.alias("start"), F.lit(at).alias("at"), F.lit(rule.kind).alias("kind"), end.alias("end"))
        return F.struct(end.alias("pos"), F.when(piece["ok"], F.concat(state["out"], F.array(span)))
                        .otherwise(state["out"]).alias("out"))

    # lists grow by copying, so they are made a run of matches at a time, each from where the runs before it end
    def placed(all_: Column) -> Column:
        runs = F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / RUN).cast("int"))
        run = lambda c: F.slice(all_, c * RUN + 1, F.lit(RUN))
        zero = F.lit(0).cast("long")
        ends = F.transform(runs, lambda c: F.aggregate(run(c), zero, lambda a, p: a + p["gap"] + p["match"]))
        return _let(ends, lambda e: F.flatten(F.transform(runs, lambda c: F.aggregate(
            run(c), F.struct(F.aggregate(F.slice(e, F.lit(1), c), zero, lambda a, x: a + x).alias("pos"), none.alias("out")),
            step)["out"])))

    return F.when(hit, _let(lengths, placed)).otherwise(none)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _blob(text: str = "text") -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _read(spark, path: str, schema: str) -> DataFrame:
    """A part of the ledger; empty before its first scan."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.exists(folder):
        return spark.read.schema(schema).parquet(path)
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(schema)])


def scan(versions: DataFrame, ledger: str, rules: list[Rule] = RULES, path: str = "doc_id") -> DataFrame:
    """``path, blob, spans`` of every row of ``versions(path, text)``; the ledger learns what was scanned.

    Findings are written before the note that a blob was scanned, so a scan that
    dies is repeated by the next one, and equal findings count once.
    """
    spark = versions.sparkSession
    rules_at = {r.tag: i for i, r in enumerate(rules)}
    have = versions.select(F.col(path).alias("path"), _blob().alias("blob"))
    tags = F.array(*[F.lit(t) for t in rules_at])
    seen = (_read(spark, f"{ledger}/scanned", "blob binary, rules array<string>")
            .groupBy("blob").agg(F.flatten(F.collect_set("rules")).alias("seen")))
    todo = (have.groupBy("blob").agg(F.min("path").alias("carrier")).join(seen, "blob", "left")
            .withColumn("todo", F.array_except(tags, F.coalesce("seen", F.array().cast("array<string>"))))
            .where(F.size("todo") > 0).select("blob", "carrier", "todo"))
    todo = stage(todo, "unseen")

    # one copy of a blob: its carrier's, matched by id and content
    texts = versions.select(F.col(path).alias("path"), F.coalesce("text", F.lit("")).alias("text")).withColumn("own", _blob())
    one = texts.join(todo, (F.col("own") == F.col("blob")) & F.col("path").eqNullSafe(F.col("carrier")))
    each = [F.when(F.array_contains("todo", r.tag), spans(F.col("text"), r, i)) for i, r in enumerate(rules)]
    found = (one.select("blob", F.explode(F.array(*[F.struct(F.lit(r.tag).alias("rule"), s.alias("spans"))
                                                    for r, s in zip(rules, each)])).alias("f"))
             .select("blob", "f.*").where(F.size("spans") > 0))
    found.write.mode("append").parquet(f"{ledger}/findings")
    todo.select("blob", F.col("todo").alias("rules")).write.mode("append").parquet(f"{ledger}/scanned")

    known = _read(spark, f"{ledger}/findings", f"blob binary, rule string, spans {_SPANS}")
    place = F.element_at(F.create_map(*[F.lit(x) for r, i in rules_at.items() for x in (r, i)]), F.col("rule"))
    findings = stage(known.where(F.col("rule").isin(*rules_at)).distinct()
                     .withColumn("spans", F.transform("spans", lambda s: s.withField("at", place)))
                     .groupBy("blob").agg(F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans")), "findings")
    return (have.join(findings, "blob", "left")
            .select(F.col("path").alias(path), "blob", F.coalesce("spans", F.array().cast(_SPANS)).alias("spans")))


def report(scanned: DataFrame, path: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, a digest of the base spans, and all spans as text, of ``scan``'s rows.

    Defined cases: null texts are scanned as empty ones; texts without findings
    have an empty list, whose digest is that of the empty string; repeated rows
    and rows with a null id get the findings of their text; an empty table gives
    an empty result; other columns are ignored.
    """
    written = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    of = lambda kind: F.filter("spans", lambda x: x["kind"] == kind)
    base = F.filter("spans", lambda x: x["kind"].isin(*[r.kind for r in BASE]))
    return scanned.select(path, *[F.size(of(r.kind)).cast("long").alias(f"n_{r.kind}") for r in BASE],
                          F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def oracle(rules: list[Rule] = RULES) -> str:
    """DuckDB SQL for the rows of the query: every rule on every text, without a ledger.

    As above, matches and the texts between them alternate.
    """
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    each = "\n  union all ".join(
        f"""select r, {i} as "at", {quoted(r.kind)} as kind, {r.least} as least,
    unnest(regexp_extract_all(t, {quoted(r.pattern)}, 0)) as match, unnest(regexp_extract_all(t, {quoted(r.pattern)}, {r.group})) as kept,
    unnest(list_slice(regexp_split_to_array(t, {quoted(r.pattern)}), 1, len(regexp_extract_all(t, {quoted(r.pattern)}, 0)))) as gap,
    unnest(range(len(regexp_extract_all(t, {quoted(r.pattern)}, 0)))) as k
  from doc where regexp_matches(t, {quoted(r.pattern)})""" for i, r in enumerate(rules))
    counts = ", ".join(f"count(*) filter (kind = {quoted(r.kind)}) as n_{r.kind}" for r in BASE)
    written = lambda on: f'''string_agg(kind || ':' || start || ':' || stop, ',' order by start, "at") {on}'''
    return f"""with doc as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
hits as ({each}),
ends as (
  select *, cast(sum(length(gap) + length(match)) over (partition by r, "at" order by k) as bigint) as stop from hits),
placed as (
  select r, "at", kind, stop, stop - length(match) as start, length(kept) >= least as ok from ends),
told as (
  select r, {counts}, {written(f'filter ("at" < {len(BASE)})')} as base, {written("")} as spans from placed where ok group by r)
select doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) as n_{r.kind}" for r in BASE)},
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from doc left join told using (r)"""

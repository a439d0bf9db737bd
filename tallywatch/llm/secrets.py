"""Secrets in every version of every path, scanned once per content and rule.

A ledger remembers what has been scanned. Every version of a text is addressed by the SHA-256 of its content, its blob;
a row of the ledger says which rules, each with its version, have been run over a blob, and which spans they found. A
scan runs only the pairs of blob and rule version that the ledger lacks: one text per blob, and of the rules those
that are new to it. Findings then go from blobs back to all paths that hold or held them.

Everything here is DataFrame expressions; no text leaves the JVM. A rule is a regular expression whose leftmost
matches that do not overlap count. Splitting the text at the matches gives the gaps before them, and running sums of
gaps and matches give the positions, in code points.

A group of copies is one blob: partial aggregates send at most one of its texts per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywatch.llm.links import stored

LEDGER_SCHEMA = "blob string, rules array<string>, spans array<struct<start: int, end: int, rule: string>>"


@dataclass(frozen=True)
class Rule:
    """A pattern that Java and RE2 read alike. A match counts if `part`, one of its groups, has `least` characters.

    Change the version whenever anything else changes: texts are then scanned anew, for this rule only.
    """

    name: str
    version: int
    pattern: str
    least: int
    part: int = 0

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"


# --- Fixed values: what counts as a secret ---------------------------------------------------------
BASE_RULES = (
    Rule("assign", 1, r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
         r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 1),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 18),
    Rule("hex", 1, r"[0-9a-f]+", 16),
)
MORE_RULES = (
    Rule("key_block", 1, r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----", 1),
    Rule("forge", 1, r"gh[opsur]_[A-Za-z0-9]+", 40),
)
# --- End of fixed values ---------------------------------------------------------------------------
RULES = (*BASE_RULES, *MORE_RULES)


def addressed(versions: DataFrame, key: Sequence[str], text: str) -> DataFrame:
    """The key columns, the text (NULL is an empty one) and its address."""
    body = F.coalesce(versions[text], F.lit(""))
    return versions.select(*(versions[k] for k in key), body.alias("text"), F.sha2(body, 256).alias("blob"))


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame | None:
    """The ledger, or None as long as nobody has written it."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(ledger)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def all_rules(rules: Sequence[Rule]) -> Column:
    return F.array(*(F.lit(r.key) for r in rules))


def unseen(blobs: DataFrame, known: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(blob, todo): per distinct blob the keys of the rules that have not been run over it, if there are any."""
    done = known.groupBy("blob").agg(F.flatten(F.collect_list("rules")).alias("done"))
    left = F.array_except(all_rules(rules), F.coalesce("done", F.array().cast("array<string>")))
    distinct = blobs.select("blob").distinct()
    return distinct.join(done, "blob", "left").select("blob", left.alias("todo")).filter(F.size("todo") > 0)


def _pieces(rule: Rule) -> Column:
    """Per match of a rule its number, the gap before it, its length, and whether it counts."""
    name = rule.name

    def piece(match: Column, number: Column) -> Column:
        counted = F.regexp_extract(match, rule.pattern, rule.part) if rule.part else match
        return F.struct(
            F.lit(rule.key).alias("rule"), number.alias("number"), F.get(F.col(f"gaps_{name}"), number).alias("gap"),
            F.length(match).alias("size"), (F.length(counted) >= rule.least).alias("counts"))

    return F.transform(f"found_{name}", piece)


def spans_of(texts: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(blob, rules, spans) of `texts` (blob, text, todo), one row per blob. Only texts with a match are split."""

    def where_found(rule: Rule, value: Column) -> Column:
        return F.when(F.size(f"found_{rule.name}") > 0, value)

    matches = [F.when(F.array_contains("todo", r.key), F.regexp_extract_all("text", F.lit(r.pattern), F.lit(0))) for r in rules]
    gaps = [F.transform(F.split("text", r.pattern, -1), lambda gap: F.length(gap)) for r in rules]
    found = texts.select("blob", "text", "todo", *(m.alias(f"found_{r.name}") for r, m in zip(rules, matches)))
    found = found.select("blob", "todo", *(f"found_{r.name}" for r in rules),
                         *(where_found(r, g).alias(f"gaps_{r.name}") for r, g in zip(rules, gaps)))
    none = F.array().cast("array<struct<rule: string, number: int, gap: int, size: int, counts: boolean>>")
    pieces = F.concat(*(F.coalesce(where_found(r, _pieces(r)), none) for r in rules))
    rows = found.select("blob", "todo", F.inline_outer(pieces))
    so_far = Window.partitionBy("blob", "rule").orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(so_far).cast("int"))
    span = F.struct((F.col("end") - F.col("size")).alias("start"), "end", "rule")
    return rows.groupBy("blob").agg(
        F.first("todo").alias("rules"), F.sort_array(F.collect_list(F.when(F.col("counts"), span))).alias("spans"))


def scan(
    spark: SparkSession, versions: DataFrame, ledger: str, rules: Sequence[Rule] = RULES,
    key: Sequence[str] = ("doc_id",), text: str = "text",
) -> DataFrame:
    """Bring the ledger up to date with all versions, and return (key..., spans): a row per version with its findings.

    `spans` holds (start, end, rule key) in the order of positions. NULL and empty texts are one blob without findings;
    equal rows give equal rows; a NULL key is a key. Other columns of `versions` do not matter, whatever their names. A
    scan that dies leaves the ledger as it was, and two at once leave a blob scanned twice, which changes no result.
    """
    columns = addressed(versions, key, text)
    paths = stored(spark, columns.select(*(F.col(k).alias(f"key_{i}") for i, k in enumerate(key)), "blob"), "paths")
    known = read_ledger(spark, ledger)
    texts = columns.select("blob", "text")
    if known is None:
        texts = texts.withColumn("todo", all_rules(rules))
    else:
        texts = texts.join(stored(spark, unseen(paths, known, rules), "unseen"), "blob")
    texts = texts.groupBy("blob").agg(F.first("text").alias("text"), F.first("todo").alias("todo"))
    spans_of(texts, rules).write.mode("append").parquet(ledger)
    return joined_back(paths, read_ledger(spark, ledger), rules).withColumnsRenamed(
        {f"key_{i}": k for i, k in enumerate(key)})


def joined_back(paths: DataFrame, ledger: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Every row of `paths`, its blob replaced by the spans that these versions of the rules found in it."""
    wanted = [r.key for r in rules]
    held = ledger.select("blob", F.filter("spans", lambda s: s["rule"].isin(wanted)).alias("spans")).filter(F.size("spans") > 0)
    held = held.groupBy("blob").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"))
    none = F.array().cast("array<struct<start: int, end: int, rule: string>>")
    found = paths.join(held, "blob", "left")
    return found.withColumn("spans", F.coalesce("spans", none)).drop("blob")


def listed(spans: Column, rules: Sequence[Rule]) -> Column:
    """kind:start:end of those spans that the rules found, by start and the order of the rules, joined by commas."""
    keys = all_rules(rules)
    names = F.array(*(F.lit(r.name) for r in rules))
    own = F.filter(spans, lambda s: F.array_contains(keys, s["rule"]))
    placed = F.array_sort(F.transform(own, lambda s: F.struct(s["start"], F.array_position(keys, s["rule"]).alias("at"), s["end"])))
    return F.array_join(F.transform(placed, lambda s: F.concat_ws(
        ":", F.get(names, (s["at"] - 1).cast("int")), s["start"].cast("string"), s["end"].cast("string"))), ",")


def number_of(spans: Column, rule: Rule) -> Column:
    return F.size(F.filter(spans, lambda s: s["rule"] == rule.key)).cast("bigint")

"""Secret scans over an incremental ledger of content-addressed texts and rule versions."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparrowmill.llm.common import stored, text_of
from sparrowmill.operators.skew import apart
from sparrowmill.sources.files import shared_folder


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost and not overlapping, whose ``group`` has ``least`` characters.

    A change of a rule is a new ``version``: texts that were scanned by an older one are scanned again.
    The pattern is read alike by Java and by RE2, so it has no look-around and no case flags.
    """

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


def either_case(pattern: str) -> str:
    """The pattern with its ASCII letters in either case, and no others."""
    return re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", pattern)


# The kinds of secrets in their order, the patterns that find them, and the least length.
KEYWORDS = "(password|passwd|secret|token|api_?key)"
RULES = (
    Rule("assign", 1, either_case(KEYWORDS) + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    # A run that is long enough is found whole, so that the runs in ordinary words are passed over.
    Rule("access", 1, "AKIA[A-Z0-9]{12,}", 0, 16),
    Rule("hex", 1, "[0-9a-f]{32,}", 0, 32),
)

FINDINGS = "blob binary, rule string, start long, end long"
SCANNED = "blob binary, rules array<string>"


def address(text: Column) -> Column:
    """A text's content address: SHA-256 of its UTF-8 bytes."""
    return F.unhex(F.sha2(F.encode(text, "UTF-8"), 256))


def _pieces(text: Column, rule: Rule) -> Column:
    """Per match: its number, the characters between it and the match before, its own, whether it counts.

    Only the arrays' elements are read inside the lambda: what stands there runs once per match.
    """
    pattern = F.lit(rule.pattern)
    zipped = F.arrays_zip(
        F.split(text, rule.pattern, -1).alias("gap"),
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("found"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("value"),
    )
    return F.transform(
        zipped,
        lambda p, nth: F.struct(
            F.lit(rule.name).alias("rule"), nth.alias("nth"), F.length(p["gap"]).alias("gap"),
            F.length(p["found"]).alias("size"), (F.length(p["value"]) >= rule.least).alias("kept"),
        ),
    )


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _unseen(texts: DataFrame, known: DataFrame | None, names: Sequence[str]) -> DataFrame:
    """blob, text, rules: each text that some rule version has not scanned, once.

    Copies fall together before the shuffle. Where the ledger has entries, addresses are compared
    first, so that the texts it knows in full stay where they are.
    """
    wanted = F.array(*[F.lit(n) for n in names])
    if known is None:
        return texts.distinct().withColumn("rules", wanted)
    done = known.groupBy("blob").agg(F.flatten(F.collect_list("rules")).alias("done"))
    missing = F.array_except(wanted, F.coalesce("done", F.array().cast("array<string>")))
    todo = (
        texts.select("blob").distinct().join(done, "blob", "left")
        .select("blob", missing.alias("rules")).where(F.size("rules") > 0)
    )
    return texts.join(apart(todo), "blob").distinct()


def update_ledger(texts: DataFrame, rules: Sequence[Rule], ledger: str) -> None:
    """Scan what the ledger at ``ledger`` lacks of ``texts`` (blob, text), and append it.

    The ledger has two Parquet tables: ``findings`` and ``scanned``, the rule versions that have seen a
    blob. Findings go first: an update that fails in between is done again, and its rows are then
    there twice, which readers drop.
    """
    spark = texts.sparkSession
    known = _read(spark, f"{ledger}/scanned", SCANNED)
    text = F.col("text")
    found = [
        F.when(F.array_contains("rules", r.name) & text.rlike(r.pattern), _pieces(text, r)) for r in rules
    ]
    empty = F.array().cast("array<struct<rule:string,nth:int,gap:int,size:int,kept:boolean>>")
    pieces = F.concat(*[F.coalesce(f, empty) for f in found])
    unseen = _unseen(texts, known, [r.name for r in rules])
    scanned = stored(unseen.select("blob", "rules", pieces.alias("pieces")))
    # A window holds the matches of one rule in one text.
    so_far = Window.partitionBy("blob", "rule").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    findings = (
        scanned.select("blob", F.inline("pieces")).where("size is not null")
        .withColumn("end", F.sum((F.col("gap") + F.col("size")).cast("long")).over(so_far))
        .where("kept")
        .select("blob", "rule", (F.col("end") - F.col("size")).alias("start"), "end")
    )
    findings.write.mode("append").parquet(f"{ledger}/findings")
    scanned.select("blob", "rules").write.mode("append").parquet(f"{ledger}/scanned")


def scan_secrets(
    versions: DataFrame, rules: Sequence[Rule] = RULES, ledger: str | None = None,
    keep: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """The secrets in every historical version of every path, one row per row of ``versions``.

    ``versions`` has ``text`` and the columns in ``keep`` that tell a path and its version, whatever
    their names but ``blob`` and ``spans``. Returns them with ``blob`` (the content address) and
    ``spans``: kind, start and end (code points, end exclusive) of all matches by start, then by the
    order of ``rules``. Null and empty texts have the address of the empty text and no spans. Repeated
    rows stay; copies of a text are scanned once and share its findings; no other column is read; an
    empty table gives an empty one.

    ``ledger`` is a folder that keeps findings from call to call: only pairs of a text and a rule
    version that it lacks are scanned. Without one the ledger starts empty in the shared folder. Two
    updates of one ledger at a time may scan a text twice, with the same result.
    """
    if taken := {"blob", "spans"}.intersection(keep):
        raise ValueError(f"columns {sorted(taken)} are what the scan adds")
    spark = versions.sparkSession
    ledger = ledger or shared_folder(spark)
    texts = versions.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), text_of().alias("text"))
    addressed = texts.withColumn("blob", address(F.col("text")))
    update_ledger(addressed.select("blob", "text"), rules, ledger)

    order = F.create_map(*[F.lit(x) for place, r in enumerate(rules) for x in (r.name, place)])
    kind = F.create_map(*[F.lit(x) for r in rules for x in (r.name, r.kind)])
    current = _read(spark, f"{ledger}/findings", FINDINGS).where(F.col("rule").isin([r.name for r in rules]))
    spans = F.sort_array(F.collect_list(F.struct("start", order[F.col("rule")].alias("place"), "rule", "end")))
    of_blob = current.distinct().groupBy("blob").agg(
        F.transform(
            spans, lambda s: F.struct(kind[s["rule"]].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
        ).alias("spans")
    )
    # All copies of a text meet its findings: one address may hold a third of the rows.
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    joined = addressed.select("row", "blob").join(apart(of_blob), "blob", "left")
    return joined.select("row.*", "blob", F.coalesce("spans", none).alias("spans"))


def listed(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )

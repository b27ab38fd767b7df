"""Secret scanning with an incremental blob ledger. DataFrame functions only.

Every version of a text is addressed by the hash of its content. The ledger remembers which (blob, rule, rule version) pairs
have been scanned and what was found; a run scans only pairs that the ledger lacks, appends them, and joins the findings of all
current rules back to every path (document) that holds the blob. A blob with a thousand paths is scanned once; a rule whose
version goes up is scanned again over all blobs, the others are not.

Spans are code points, end exclusive, leftmost and non-overlapping for each kind. A rule's pattern is matched first and
matches that are too short are dropped afterwards. Null text is the empty text. Rows may repeat and ids may be null: each row
gets its blob's findings. An empty table gives no row.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewire.llm.base import id_and_text, read
from tidewire.session import checkpoint_dir, cut_lineage


class Rule(NamedTuple):
    """A kind of secret: matches of the pattern whose given group has at least so many characters."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int
    #: A cheaper pattern that every text with a finding matches.
    hint: str


#: In the order in which kinds are listed. The first three are the base rules.
RULES = (
    Rule(
        "assign",
        1,
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
        r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
        r"""(?:[Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6}""",
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20, r"AKIA[A-Z0-9]{16}"),
    # every maximal run of 24 or more is what [0-9a-f]+ finds and keeps
    Rule("hex", 1, r"[0-9a-f]{24,}", 0, 24, r"[0-9a-f]{24}"),
    Rule("private_key", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
BASE = ("assign", "access", "hex")
_KEY_HEADER = r"-----BEGIN ([A-Z ]*)PRIVATE KEY-----"
_KEY_GAP = r"(?:\s|\\[nr])*"
#: What is masked: RULES, with the whole key in place of its header, up to the END line of its kind or, without one, over the
#: named fields and the lines of base64 that follow (at most 400, a few times the longest key).
MASKED = (
    *(r for r in RULES if r.kind != "private_key"),
    Rule(
        "private_key",
        2,
        _KEY_HEADER
        + r"(?:[^-]*+(?:-[^-]++){0,64}-----END \1PRIVATE KEY-----"
        + rf"|(?:{_KEY_GAP}(?:Proc-Type|DEK-Info):[^\r\n]*){{0,8}}(?:{_KEY_GAP}[A-Za-z0-9+/]{{16,}}={{0,2}}){{1,400}}(?:\s*\n[A-Za-z0-9+/]{{1,15}}={{0,2}}(?=\s*(?:\n|\z)))?"
        + r"|)",
        0,
        1,
        _KEY_HEADER,
    ),
)
SPANS = "array<struct<start:long,end:long>>"
FINDINGS = "array<struct<start:long,rank:long,end:long,kind:string>>"
LEDGER = f"blob string, kind string, version int, spans {SPANS}"


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def spans_of(text: Column, rule: Rule) -> Column:
    """The kept matches of a rule. What lies between matches and the matches take turns, so their lengths add up to places."""
    between = F.split(text, rule.pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    measured = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else whole
    steps = F.zip_with(whole, measured, lambda w, m: F.struct(F.length(w).cast("long").alias("whole"), F.length(m).cast("long").alias("measured")))
    steps = F.zip_with(F.slice(between, F.lit(1), F.size(whole)), steps, lambda b, s: F.struct(F.length(b).cast("long").alias("gap"), s.whole.alias("whole"), s.measured.alias("measured")))
    nothing = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPANS).alias("spans"))

    def add(state: Column, step: Column) -> Column:
        start = state["at"] + step["gap"]
        end = start + step["whole"]
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(step["measured"] >= rule.least, F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    found = F.aggregate(steps, nothing, add, lambda state: state["spans"])
    return F.when(text.rlike(rule.hint), found).otherwise(F.array().cast(SPANS))


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.range(0).select(*[F.lit(None).cast(kind).alias(name) for name, kind in (x.split(" ", 1) for x in LEDGER.split(", "))])


def ledger_entry(rule: Rule) -> Column:
    return F.struct(F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"), spans_of(F.col("text"), rule).alias("spans"))


def scan_unseen(versions: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows for every pair of a blob among versions (blob, text) and a rule version that the ledger lacks.

    One row of each blob is kept before the texts are shuffled and one after; a group of copies leaves one text for each task.
    """
    one_each = versions.withColumn("n", F.row_number().over(Window.partitionBy("blob").orderBy("blob"))).filter("n = 1").drop("n")
    current = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])
    seen = ledger.select("blob", "kind", "version").groupBy("blob").agg(F.collect_set(F.struct("kind", "version")).alias("seen"))
    wanted = one_each.join(seen, "blob", "left").withColumn("unseen", F.when(F.col("seen").isNull(), current).otherwise(F.array_except(current, "seen")))
    found = [F.when(F.array_contains(F.col("unseen.kind"), rule.kind), ledger_entry(rule)) for rule in rules]
    rows = wanted.select("blob", F.explode(F.array_compact(F.array(*found))).alias("x"))
    return rows.select("blob", "x.kind", "x.version", "x.spans")


def update_ledger(texts: DataFrame, ledger_path: str, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> None:
    """Scan what the ledger lacks and append it. The ledger is a folder of Parquet parts; each run adds some."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    versions = texts.select(text.alias("text")).withColumn("blob", blob_of(F.col("text")))
    scan_unseen(versions, read_ledger(texts.sparkSession, ledger_path), rules).write.mode("append").parquet(ledger_path)


def findings_of(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """blob and findings (start, rank, end, kind; by start, then kind as listed) of the rules' current versions, blobs without any left out.

    A pair that a repeated run wrote twice counts once.
    """
    rank = F.array(*[F.lit(r.kind) for r in rules])
    current = F.concat_ws(":", "kind", "version").isin([f"{r.kind}:{r.version}" for r in rules])
    spans = ledger.filter(current & (F.size("spans") > 0)).select("blob", "kind", F.explode("spans").alias("s")).distinct()
    each = F.struct(F.col("s.start").alias("start"), F.array_position(rank, F.col("kind")).alias("rank"), F.col("s.end").alias("end"), F.col("kind"))
    return spans.groupBy("blob").agg(F.sort_array(F.collect_list(each)).alias("findings"))


def with_findings(rows: DataFrame, findings: DataFrame) -> DataFrame:
    """rows (with a blob) and the findings of their blob."""
    return rows.join(findings, "blob", "left").withColumn("findings", F.coalesce("findings", F.array().cast(FINDINGS)))


def scan(docs: DataFrame, ledger_path: str, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, blob and findings of every row, after bringing the ledger up to date."""
    rows = id_and_text(docs, id_col, text_col)
    update_ledger(rows, ledger_path, rules)
    findings = findings_of(read_ledger(docs.sparkSession, ledger_path), rules)
    return with_findings(rows.select("doc_id", blob_of(F.col("text")).alias("blob")), findings).select("doc_id", "blob", "findings")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger so far; empty before the first run."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
    return spark.read.schema(LEDGER).parquet(path) if there else empty_ledger(spark)


def new_ledger(spark: SparkSession) -> str:
    """A fresh folder for a run that keeps no history."""
    return f"{checkpoint_dir(spark)}/ledgers/{uuid.uuid4().hex}"


def of_kinds(findings: str, *kinds: str) -> Column:
    return F.filter(findings, lambda x: x["kind"].isin(*kinds))


def joined(findings: Column) -> Column:
    return F.array_join(F.transform(findings, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def without_findings(text: Column, findings: Column, mark: str) -> Column:
    """The text with each stretch of findings that touch or overlap replaced by the mark; findings are sorted by start."""
    begin = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(state: Column, x: Column) -> Column:
        gap = F.substring(text, (state["at"] + 1).cast("int"), (x["start"] - state["at"]).cast("int"))
        fresh = (x["start"] > state["at"]) | (state["at"] == 0)
        return F.struct(
            F.when(fresh, F.concat(state["out"], gap, F.lit(mark))).otherwise(state["out"]).alias("out"), F.greatest(state["at"], x["end"]).alias("at")
        )

    rest = lambda state: F.concat(state["out"], F.substring(text, (state["at"] + 1).cast("int"), F.length(text)))
    return F.when(F.size(findings) == 0, text).otherwise(F.aggregate(findings, begin, step, rest))


def op8_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = cut_lineage(scan(read(spark, folder, "documents"), new_ledger(spark)))
    base = of_kinds("findings", *BASE)
    counts = [F.size(of_kinds("findings", kind)).cast("long").alias(f"n_{kind}") for kind in BASE]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("findings")).alias("spans"))

"""Secret scanning with an incremental blob ledger, in SQL functions only."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paywatch.llm.common import stage, stage_path


class Rule(NamedTuple):
    """A pattern whose matches are findings if the group has at least `least` characters."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The three base rules. Runs of hex digits and access ids are cut at their least length in the
# pattern itself, which finds the same matches; an assignment consumes short values and is dropped afterwards.
BASE_RULES = (
    Rule("assign", 1, r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", 1, r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", 1, r"[0-9a-f]{16,}"),
)
MORE_RULES = (
    Rule("pem", 1, r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----"),
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", 1, r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", 1, r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE_RULES + MORE_RULES
# A finding and its share of a blob's address: about 32 MB.
BROADCAST_SPANS = 250_000
HIT = "struct<rule:string,kind:string,gaps:array<int>,matches:array<int>,values:array<int>>"
SPANS = "array<struct<start:bigint,rank:bigint,kind:string,end:bigint>>"


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def _lengths(strings: Column) -> Column:
    return F.transform(strings, F.length)


def _hit(rule: Rule, text: Column) -> Column:
    """Lengths of the matches of a rule, of their groups and of the text between them; null without a match."""
    pattern = F.lit(rule.pattern)
    return F.when(
        text.rlike(rule.pattern),
        F.struct(
            F.lit(rule.key).alias("rule"),
            F.lit(rule.kind).alias("kind"),
            _lengths(F.split(text, rule.pattern, -1)).alias("gaps"),
            _lengths(F.regexp_extract_all(text, pattern, F.lit(0))).alias("matches"),
            _lengths(F.regexp_extract_all(text, pattern, F.lit(rule.group))).alias("values"),
        ),
    )


class Ledger:
    """What has been scanned: one row per blob and run, with the rule versions it was scanned for and their hits.

    A blob is a text, addressed by its SHA-256; any number of paths and versions may hold it. The ledger is an
    append-only Parquet folder on shared storage; a run that fails commits nothing and is simply run again.
    No secret is stored, only lengths.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        empty = spark.range(0).select(
            F.lit("").alias("blob"), F.array().cast("array<string>").alias("rules"), F.array().cast(f"array<{HIT}>").alias("hits")
        )
        self.schema = empty.schema
        empty.write.mode("ignore").parquet(path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def scan(self, docs: DataFrame, rules: Sequence[Rule] = RULES) -> None:
        """Scan the pairs of blob and rule version that the ledger does not have.

        Copies of a blob fall together before the shuffle, so a text that a third of all rows hold is one row.
        """
        blobs = docs.select(blob_id(F.col("text")).alias("blob"), F.coalesce("text", F.lit("")).alias("text"))
        blobs = blobs.groupBy("blob").agg(F.any_value("text").alias("text"))
        done = self.read().select("blob", F.explode("rules").alias("rule")).groupBy("blob").agg(F.collect_set("rule").alias("done"))
        asked = F.array(*(F.lit(r.key) for r in rules))
        fresh = blobs.join(done, "blob", "left").withColumn("rules", F.array_except(asked, F.coalesce("done", F.array().cast("array<string>"))))
        text = F.col("text")
        hits = F.array(*(F.when(F.array_contains("rules", r.key), _hit(r, text)) for r in rules))
        scanned = fresh.where(F.size("rules") > 0).select("blob", "rules", F.array_compact(hits).cast(f"array<{HIT}>").alias("hits"))
        scanned.write.mode("append").parquet(self.path)

    def spans(self, rules: Sequence[Rule] = RULES) -> DataFrame:
        """(blob, spans): the findings of these rules, as structs (start, rank, kind, end) in that order.

        Hits of other versions of a rule are not read. Blobs without a finding have no row. Offsets are code points,
        end exclusive.
        """
        names = [r.key for r in rules]
        keys = F.array(*(F.lit(k) for k in names))
        rank = F.array_position(keys, F.col("rule"))
        least = F.element_at(F.create_map(*(x for r in rules for x in (F.lit(r.key), F.lit(r.least)))), F.col("rule"))
        hits = self.read().where(F.arrays_overlap("rules", keys)).select("blob", "rules", F.explode("hits").alias("hit"))
        # Rows of ledgers from before hits had a rule name it in their rules.
        rule = F.expr("coalesce(hit.rule, get(filter(rules, r -> r like concat(hit.kind, '@%')), 0))")
        hits = hits.withColumn("rule", rule).where(F.col("rule").isin(names))
        # Two runs at once may both have recorded a blob: their hits are the same and count once.
        hits = hits.groupBy("blob", "rule").agg(F.any_value("hit").alias("hit"))
        each = hits.select("blob", "rule", F.col("hit.kind").alias("kind"), rank.alias("rank"), F.posexplode(F.arrays_zip("hit.gaps", "hit.matches", "hit.values")).alias("i", "x"))
        before = "sum(x.gaps + coalesce(x.matches, 0)) over (partition by blob, rule order by i)"
        placed = each.withColumn("end", F.expr(before)).where(F.col("x.matches").isNotNull() & (F.col("x.values") >= least))
        span = F.struct((F.col("end") - F.col("x.matches")).alias("start"), "rank", "kind", "end")
        return placed.groupBy("blob").agg(F.array_sort(F.collect_list(span)).alias("spans"))


def new_ledger(spark: SparkSession) -> Ledger:
    return Ledger(spark, stage_path(spark, "ledger"))


def find_secrets(docs: DataFrame, ledger: Ledger, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(doc_id, spans): the findings of every document row, joined back from the ledger by content.

    Null and empty texts have no span; repeated rows, rows without an id and copies each give a row. An empty
    table gives an empty result. Other columns are not read.
    """
    ledger.scan(docs, rules)
    paths = docs.select(F.col("doc_id").cast("long").alias("doc_id"), blob_id(F.col("text")).alias("blob"))
    found = paths.join(stage(ledger.spans(rules), "spans"), "blob", "left")  # stored, so a hot blob on the left can be split
    return found.select("doc_id", F.coalesce(F.col("spans").cast(SPANS), F.array().cast(SPANS)).alias("spans"))


def listing(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _few(marks: DataFrame) -> DataFrame:
    """The findings to be cut out, broadcast up to BROADCAST_SPANS of them; beyond, their join shuffles."""
    spans = marks.agg(F.sum(F.size("marks"))).first()[0] or 0
    return F.broadcast(marks) if spans <= BROADCAST_SPANS else marks


def redact(docs: DataFrame, ledger: Ledger, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The same rows and columns, with every finding in `text` replaced by [kind] and n_chars, if there, renewed.

    Findings that overlap are replaced together, under the kind of the first. Null and empty texts stay as they are,
    repeated rows are redacted alike, an empty table gives an empty result. Columns may have any names.
    """
    ledger.scan(docs, rules)
    found = ledger.spans(rules).select("blob", F.explode("spans").alias("s"))
    found = found.withColumn("reach", F.expr("max(s.end) over (partition by blob order by s.start, s.rank rows between unbounded preceding and 1 preceding)"))
    found = found.withColumn("run", F.expr("sum(cast(reach is null or s.start >= reach as int)) over (partition by blob order by s.start, s.rank)"))
    merged = found.groupBy("blob", "run").agg(F.min("s.start").alias("start"), F.max("s.end").alias("end"), F.min_by("s.kind", F.struct("s.start", "s.rank")).alias("kind"))
    marks = merged.groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind"))).alias("marks"))
    marks = stage(marks, "marks")
    rows = docs.select(F.struct("*").alias("row"), blob_id(F.col("text")).alias("key"))
    joined = rows.join(_few(marks), F.col("key") == F.col("blob"), "left")
    old = F.col("row.text")
    index = F.sequence(F.lit(0), F.size("marks") - 1)
    begin = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get(F.col("marks.end"), i - 1))
    piece = lambda i: F.concat(
        F.substring(old, begin(i).cast("int") + 1, (F.get(F.col("marks.start"), i) - begin(i)).cast("int")),
        F.lit("["), F.get(F.col("marks.kind"), i), F.lit("]"),
    )
    tail = F.substring(old, F.element_at(F.col("marks.end"), -1).cast("int") + 1, F.length(old))
    text = F.when(F.col("marks").isNull(), old).otherwise(F.concat(F.array_join(F.transform(index, piece), ""), tail))
    joined = joined.select("row", F.col("marks").isNotNull().alias("marked"), text.alias("new"))
    now = {"text": F.col("new")}
    if "n_chars" in docs.columns:
        renewed = F.length("new").cast(docs.schema["n_chars"].dataType)
        now["n_chars"] = F.when(F.col("marked"), renewed).otherwise(F.col("row.n_chars"))
    return joined.select(*(now.get(c, F.col("row")[c]).alias(c) for c in docs.columns))

"""Secret scans with an incremental blob ledger.

Every version of every path is addressed by its content: the SHA-256 of its text
is its blob. The ledger holds, for each blob, the rule versions that it has been
scanned with and the findings. A scan looks up all versions in the ledger, takes
one version for each blob that some rule version has not seen, scans its text
with those rules only, and appends the findings. Findings of all paths then come
from a join on the blob, so a text that a third of all paths hold is read once.

A rule's version is the digest of what defines it, so a changed rule is run
again, alone, over all blobs. An append that breaks off leaves no rows and is
done again by the next scan.

Defined cases: a null text is scanned as the empty text; repeated rows each get
their findings; an empty table gives an empty ledger and no rows; columns other
than the id and the text are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from hashlib import sha256

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from usagelens import session
from usagelens.llm import base


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches; those whose group is shorter than least are dropped."""

    kind: str
    pattern: str
    group: int
    least: int

    @property
    def version(self) -> str:
        return f"{self.kind}-{sha256(repr((self.pattern, self.group, self.least)).encode()).hexdigest()[:16]}"


RULES = (
    Rule("assign", r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]+", 0, 16),
)

LEDGER = "blob string, rules array<string>, findings array<struct<rule:string,kind:string,start:long,end:long>>"


def scan(text: str, rules: list[tuple[str, str, re.Pattern, int, int]]) -> list[dict]:
    """Findings of one text by start, then rule; offsets in code points, end exclusive."""
    found = []
    for order, (version, kind, pattern, group, least) in enumerate(rules):
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                found.append((m.start(), order, m.end(), version, kind))
    return [{"rule": v, "kind": k, "start": s, "end": e} for s, _, e, v, k in sorted(found)]


def blob(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a ledger; one that was never written has none."""
    schema = StructType.fromDDL(LEDGER)
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def unseen(versions: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One version (path, blob) for each blob with rule versions that it has not been scanned with (todo)."""
    wanted = F.array(*[F.lit(r.version) for r in rules])
    seen = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
    first = versions.groupBy("blob").agg(F.min("path").alias("path"))
    todo = first.join(seen, "blob", "left").withColumn("todo", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>"))))
    return todo.filter(F.size("todo") > 0).select("path", "blob", "todo")


def update(texts: DataFrame, path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Bring the ledger at path up to date with texts (path, text); returns the ledger.

    Only texts that must be scanned are needed beyond their blob. When few are new,
    the runtime broadcasts their short list and no text is shuffled; when most are
    new, texts are shuffled once.
    """
    spark = texts.sparkSession
    versions = texts.select("path", "text", blob(F.col("text")).alias("blob"))
    todo = unseen(versions.select("path", "blob"), read_ledger(spark, path), rules)
    own = F.col("v.path").eqNullSafe(F.col("t.path")) & (F.col("v.blob") == F.col("t.blob"))
    work = versions.alias("v").join(todo.alias("t"), own).select("t.blob", "t.todo", "v.text")

    def make():
        known = {r.version: (r.version, r.kind, re.compile(r.pattern), r.group, r.least) for r in rules}

        def act(batch):
            columns = (batch.column(c).to_pylist() for c in ("blob", "todo", "text"))
            rows = [(b, t, scan(x or "", [known[v] for v in known if v in t])) for b, t, x in zip(*columns, strict=True)]
            return list(map(list, zip(*rows, strict=True)))

        return act

    # A repeated row is the same path and blob twice; findings are the same, so one is enough.
    base.map_batches(work, make, LEDGER).write.mode("append").parquet(path)
    return read_ledger(spark, path)


def findings(texts: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Every version (path, blob) with all findings of its blob under the given rules."""
    current = F.array(*[F.lit(r.version) for r in rules])
    # Scans that ran at once may both have listed a blob: a finding counts once.
    own = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_set("findings"))).alias("all"))
    order = F.array(*[F.lit(r.kind) for r in rules])
    found = F.filter("all", lambda x: F.array_contains(current, x["rule"]))
    ordered = F.array_sort(F.transform(found, lambda x: F.struct(x["start"], F.array_position(order, x["kind"]).alias("at"), x["end"], x["kind"], x["rule"])))
    versions = texts.select("path", blob(F.col("text")).alias("blob"))
    # Written first, so that both sides of the join are shuffled as they are and a blob with many versions can be split.
    return versions.join(base.saved(own.select("blob", ordered.alias("findings")), "found"), "blob", "left")


def digest(found: DataFrame) -> DataFrame:
    """Counts by kind and the joined spans of each version."""
    count = lambda kind: F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    spans = F.array_join(F.transform("findings", lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    return found.select(F.col("path").alias("doc_id"), *map(count, ("assign", "access", "hex")), F.sha2(spans, 256).alias("base_sha256"), spans.alias("spans"), "blob")


def documents_secrets(docs: DataFrame, ledger_path: str | None = None) -> DataFrame:
    """Scan documents as versions of the path that their id names."""
    texts = docs.select(F.col("doc_id").alias("path"), "text")
    ledger = update(texts, ledger_path or session.scratch_dir(docs.sparkSession, "ledger"))
    return digest(findings(texts, ledger))

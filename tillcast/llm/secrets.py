"""Operator 5, secret scans: candidates judged by how many repositories and owners hold them.

Patterns find assignments, access keys and hex strings, and, beyond these, long mixed tokens. Each candidate's value is
hashed; over the whole corpus the distinct repositories and owners of a hash are counted. A value that many owners hold
is a copied example, and so is one in many repositories, be it of a single owner; one that a single owner holds in a few
repositories looks live. Base spans are reported whatever their owners; a mixed
token joins the spans only if it looks live and meets no base span.

Everything is DataFrame functions. Places come from the lengths of the text between matches, summed over a document.
Counts are by hash and owner first, so a value that a third of all rows hold is one row per task.

A null or empty text has no spans. A null owner or repository counts as one owner or repository. Rows are judged one by
one, so repeated rows give repeated rows. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.common import table, written

# Kinds in the order of the result, their patterns, the group of the value and its least length.
KINDS = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
]
BASE = len(KINDS)
#: Beyond the base: runs of token characters that mix digits and both cases.
MIXED = ("mixed", r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{24,}+", 0, 24)
#: Owners from which on a value is a copied example.
WIDE = 3
#: Repositories from which on it is one, whoever owns them; an owner's own credential is in a few.
MANY = 10


def matches(text: Column, rank: int, pattern: str, group: int, least: int) -> Column:
    """Matches of one pattern in order: characters before and in each, and the hash of its value."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    places = F.zip_with(F.split(text, pattern, -1), whole, lambda gap, m: F.struct(F.length(gap).alias("gap"), F.length(m).alias("size")))

    def row(place, v):
        mixed = v.rlike("[0-9]") & v.rlike("[a-z]") & v.rlike("[A-Z]") if rank == BASE else F.lit(True)
        return F.struct(
            F.lit(rank).alias("kind"), place["gap"].alias("gap"), place["size"].alias("size"),
            F.when((F.length(v) >= least) & mixed, F.md5(v.cast("binary"))).alias("value"),
        )

    numbered = F.transform(F.zip_with(places, value, row), lambda m, n: F.struct(n.alias("n"), *(m[c].alias(c) for c in ("kind", "gap", "size", "value"))))
    return F.when(text.rlike(pattern), F.filter(numbered, lambda m: m["size"].isNotNull()))


def scan(documents: DataFrame, repository: Column, owner: Column) -> DataFrame:
    """One row per document with its candidates, text left behind."""
    none = F.array().cast("array<struct<n:int,kind:int,gap:int,size:int,value:string>>")
    found = [F.coalesce(matches(F.col("text"), k, *kind[1:]), none) for k, kind in enumerate([*KINDS, MIXED])]
    return written(
        documents.select(
            F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
            F.coalesce(repository.cast("string"), F.lit("")).alias("repository"), F.coalesce(owner.cast("string"), F.lit("")).alias("owner"),
            F.concat(*found).alias("found"),
        )
    )


def candidates(scanned: DataFrame) -> DataFrame:
    """(row, repository, owner, kind, start, end, value) of each candidate."""
    rows = scanned.select("row", "repository", "owner", F.explode("found").alias("m")).select("row", "repository", "owner", "m.*")
    so_far = Window.partitionBy("row", "kind").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum((F.col("gap") + F.col("size")).cast("long")).over(so_far)
    placed = rows.withColumn("end", end).withColumn("start", F.col("end") - F.col("size"))
    return placed.where("value is not null").select("row", "repository", "owner", "kind", "start", "end", "value")


def ownership(found: DataFrame) -> DataFrame:
    """Distinct repositories and owners of each value."""
    repositories = found.select("value", "repository").distinct().groupBy("value").agg(F.count("*").alias("n_repositories"))
    owners = found.select("value", "owner").distinct().groupBy("value").agg(F.count("*").alias("n_owners"))
    return repositories.join(owners, "value")


def judged(found: DataFrame, wide: int = WIDE, many: int = MANY) -> DataFrame:
    """Candidates with their value's counts and verdict.

    An example has ``wide`` owners or ``many`` repositories or more; of the others one owner's are live, the rest shared.
    """
    verdict = F.when((F.col("n_owners") >= wide) | (F.col("n_repositories") >= many), "example").when(F.col("n_owners") == 1, "live").otherwise("shared")
    return found.join(ownership(found), "value").withColumn("verdict", verdict)


def scan_secrets(documents: DataFrame, repository: Column, owner: Column, wide: int = WIDE, many: int = MANY) -> DataFrame:
    """Per document: base counts and digest, all spans, and candidates by verdict."""
    scanned = scan(documents, repository, owner)
    found = written(candidates(scanned))
    span = F.struct("start", "kind", "end", "verdict")
    spans = judged(found, wide, many).groupBy("row").agg(F.sort_array(F.collect_list(span)).alias("all"))
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,verdict:string>>")
    rows = scanned.select("row", "doc_id").join(spans, "row", "left").withColumn("all", F.coalesce("all", none))
    rows = rows.withColumn("base", F.filter("all", lambda s: s["kind"] < BASE))
    live = F.filter("all", lambda s: (s["kind"] == BASE) & (s["verdict"] == "live"))
    more = F.filter(live, lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    names = F.array(*[F.lit(k[0]) for k in [*KINDS, MIXED]])
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda test: F.size(F.filter("all", test)).cast("long")
    of_kind = lambda k: count(lambda s: s["kind"] == k)
    return rows.select(
        "doc_id",
        *[of_kind(k).alias(f"n_{kind[0]}") for k, kind in enumerate(KINDS)],
        F.sha2(text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        text(F.sort_array(F.concat("base", more))).alias("spans"),
        count(lambda s: (s["kind"] < BASE) & (s["verdict"] == "live")).alias("n_live"),
        count(lambda s: (s["kind"] < BASE) & (s["verdict"] == "example")).alias("n_example"),
    )


def op5_secret_scan(spark, folder: str) -> DataFrame:
    """Documents stand for repositories, sources for owners."""
    return scan_secrets(table(spark, folder, "documents"), F.col("doc_id"), F.col("source"))

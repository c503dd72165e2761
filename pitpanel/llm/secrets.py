"""Secret scans over a history of texts by an incremental ledger of blobs, with Spark expressions only.

Every version of a text is a blob, addressed by its SHA-256. The ledger (Parquet, appended to) holds, per blob, the rules
(with version) that have scanned it and the spans they found; a span's kind is its rule's place among the rules of the scan
that reads it. A scan reads only blobs that some rule version has not seen,
one copy of each, and joins the findings of the ledger back to all paths. Spans count code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitpanel.llm.shared import cut, join_small, let, new_path, writing

#: kind -> (pattern, group whose length counts, least length); the order breaks ties of spans at the same start.
RULES = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
    "github": (r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    "slack": (r"xox[abprs]-[A-Za-z0-9-]+", 0, 20),
    # where a start fails, all later ones of its run of letters do: the run is consumed, with nothing in the group
    "jwt": (r"(eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+)|eyJ[A-Za-z0-9_-]+", 1, 40),
    "pem": (r"-----BEGIN (?:[A-Z]+ ){0,4}PRIVATE KEY-----", 0, 20),
}
#: Patterns that a text must hold for the rule of RULES to find anything; cheaper to look for. Other versions go without.
NEEDS = {
    "assign": r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]", "access": r"AKIA[A-Z0-9]{16}", "hex": r"[0-9a-f]{24}",
    "github": r"gh[pousr]_", "slack": r"xox[abprs]-", "jwt": r"eyJ", "pem": r"-----BEGIN ",
}
SPANS = "array<struct<start:bigint,kind:int,end:bigint>>"
PLACES = "array<struct<start:bigint,end:bigint>>"
CHUNK = 256


def rule_keys(rules: dict = RULES) -> dict[str, str]:
    """kind -> its key in the ledger: changes with the pattern or the least length."""
    from hashlib import sha256

    return {k: f"{k}@{sha256(repr(r).encode()).hexdigest()[:12]}" for k, r in rules.items()}


def spans(text: Column, kind: str, rules: dict = RULES) -> Column:
    """The kept matches of a rule (start, end): what lies between matches and the matches themselves give all places."""
    pattern, group, least = rules[kind]
    hits = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), F.length).alias("gap"),
        F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length).alias("n"),
        F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.length).alias("key"),
    )
    # places are running sums; arrays grow by copying, so they are summed in runs of CHUNK, then within each run
    step = lambda x: x["gap"] + F.coalesce(x["n"], F.lit(0))
    zero, none = F.lit(0).cast("long"), F.array().cast(PLACES)

    def starts(runs: Column) -> Column:
        ends = F.transform(runs, lambda r: F.aggregate(r, zero, lambda a, x: a + step(x)))
        first = F.struct(zero.alias("at"), F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(ends, first, lambda a, n: F.struct((a["at"] + n).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")))["out"]

    def within(run: Column, start: Column) -> Column:
        def more(a: Column, x: Column) -> Column:
            at = a["at"] + x["gap"]
            kept = F.concat(a["out"], F.array(F.struct(at.alias("start"), (at + x["n"]).alias("end"))))
            return F.struct((a["at"] + step(x)).alias("at"), F.when(x["key"] >= least, kept).otherwise(a["out"]).alias("out"))

        return F.aggregate(run, F.struct(start.alias("at"), none.alias("out")), more)["out"]

    runs = let(hits, lambda h: F.transform(F.sequence(F.lit(0), F.floor((F.size(h) - 1) / CHUNK).cast("int")), lambda i: F.slice(h, i * CHUNK + 1, CHUNK)))
    found = let(runs, lambda r: F.flatten(F.zip_with(r, starts(r), within)))
    known = kind in NEEDS and rules[kind] == RULES[kind]
    return F.when(text.rlike(NEEDS[kind]) if known else F.lit(True), found).otherwise(F.array().cast(PLACES))


def read_ledger(spark, ledger: str, rules: dict) -> DataFrame | None:
    """(blob, seen array<rule key>, spans) of the present rule versions; None before the first scan."""
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    keys = F.array(*map(F.lit, rule_keys(rules).values()))
    rows = spark.read.parquet(ledger).select("blob", F.map_filter("found", lambda k, _: F.array_contains(keys, k)).alias("found"))
    own = F.flatten(F.transform(F.map_entries("found"), lambda e: F.transform(e["value"], lambda s: F.struct(
        s["start"].alias("start"), (F.array_position(keys, e["key"]) - 1).cast("int").alias("kind"), s["end"].alias("end")
    ))))
    return rows.groupBy("blob").agg(
        F.array_distinct(F.flatten(F.collect_list(F.map_keys("found")))).alias("seen"),
        # sorted, then each of which the one before is equal left out: array_distinct compares structs with all others
        let(F.array_sort(F.flatten(F.collect_list(own))), lambda s: F.filter(s, lambda x, i: (i == 0) | (x != F.get(s, i - 1)))).alias("spans"),
    )


def scan_history(versions: DataFrame, ledger: str | None = None, rules: dict = RULES) -> DataFrame:
    """(doc_id, text) of every version -> doc_id, blob, spans array<struct<start,kind,end>> by start, then kind.

    Null texts are empty blobs; repeated rows and ids each get their row; a null doc_id stays null; other columns are
    ignored; an empty table scans nothing. Rows with equal texts are scanned once, whatever their number.
    """
    spark = versions.sparkSession
    ledger = ledger or new_path(spark, "ledger")
    keys = rule_keys(rules)
    text = F.coalesce("text", F.lit(""))
    blob = F.unhex(F.sha2(text, 256))
    paths = cut(versions.select("doc_id", blob.alias("blob")), "paths")
    known = read_ledger(spark, ledger, rules)
    # a blob that many paths share is scanned by the row of its least doc_id
    blobs = paths.groupBy("blob").agg(F.min("doc_id").alias("first"))
    every = F.array(*map(F.lit, keys.values()))
    if known is not None:
        blobs = blobs.join(known, "blob", "left").withColumn("todo", F.array_except(every, F.coalesce("seen", F.array().cast("array<string>"))))
    else:
        blobs = blobs.withColumn("todo", every)
    todo = blobs.where(F.size("todo") > 0).select("blob", "first", "todo")
    src = versions.select("doc_id", text.alias("text"), blob.alias("blob"), F.coalesce("doc_id", F.lit(0)).alias("at"), F.isnull("doc_id").alias("none"))
    todo = todo.select("blob", "todo", F.coalesce("first", F.lit(0)).alias("at"), F.isnull("first").alias("none"))
    src = src.join(todo, ["blob", "at", "none"])
    found = F.map_from_arrays(every, F.array(*(
        F.when(F.array_contains("todo", key), spans(F.col("text"), kind, rules)) for kind, key in keys.items()
    )))
    rows = src.select("blob", F.map_filter(found, lambda _, v: v.isNotNull()).alias("found"))
    with writing(spark):
        rows.write.mode("append").parquet(ledger)
    hits = cut(read_ledger(spark, ledger, rules).where(F.size("spans") > 0).select("blob", "spans"), "hits")
    # few blobs have findings: while they are few enough, no path is shuffled
    return join_small(paths, hits, "blob", "left").select("doc_id", "blob", F.coalesce("spans", F.array().cast(SPANS)).alias("spans"))

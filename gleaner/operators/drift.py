"""Schemas that drift between files: a catalogue of column lifespans.

Every readable record's top-level fields are catalogued per producer, file, field and type.
Islands of consecutive files (lag over the file number) give each field-type's lifespans; their
starts and endings are the change log. Values of records sent again in the next file tell a
renaming from a removal plus an addition.
"""

from __future__ import annotations

from collections import Counter, defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.session import written

# Known names of one quantity, canonical name first, with the type of its column.
ALIASES = {
    "crawl_timestamp": ("bigint", ["crawl_timestamp", "crawler_timestamp", "Crawl_Timestamp", "crawlTimestamp", "fetched_at"]),
    "score": ("double", ["score", "link_score", "linkScore", "page_score", "importance"]),
    "response_code": ("bigint", ["response_code", "http_code"]),
    "crawl_time": ("double", ["crawl_time", "crawler_duration", "fetch_seconds"]),
    "dns_time": ("double", ["dns_time", "namelookup_time"]),
    "donwload_speed": ("double", ["donwload_speed", "download_speed"]),
    "content_type": ("string", ["content_type", "mime"]),
    "redirect_count": ("bigint", ["redirect_count", "redirect_times"]),
    "file_time": ("bigint", ["file_time", "last_modified", "file_timestamp"]),
    "header_size": ("bigint", ["header_size"]),
    "is_truncated": ("boolean", ["is_truncated", "truncated"]),
    "simhash": ("bigint", ["simhash", "page_sig"]),
    "robots_level": ("bigint", ["robots_level"]),
    "charset": ("string", ["charset"]),
}


def _kind(of: Column) -> Column:
    """JSON type of a variant, from its schema: null for a JSON null."""
    wide = F.regexp_extract(of, r"^DECIMAL\((\d+),0\)$", 1)
    return (
        F.when(of == "VOID", F.lit(None))
        .when(of == "STRING", "string")
        .when(of == "BOOLEAN", "boolean")
        .when(of == "BIGINT", "whole")
        .when((wide != "") & (wide.cast("int") >= 19), "whole")  # beyond 64 bits
        .when(of.startswith("ARRAY"), "list")
        .when(of.startswith("OBJECT"), "object")
        .otherwise("fraction")
    )


def record_fields(batches: DataFrame, record_key: str = "rec_no") -> DataFrame:
    """One row per readable record and field: feed, batch_no, rec (the record key), name, kind, value.

    Unreadable payloads (cut off, empty, null, not an object) give no rows. value is the JSON
    text, null for JSON null.
    """
    spark = batches.sparkSession
    parsed = (
        batches.select("feed", "batch_no", F.try_parse_json("payload").alias("v"))
        .filter(F.col("v").isNotNull() & F.schema_of_variant("v").startswith("OBJECT"))
        .withColumn("rec", F.try_variant_get("v", f"$.{record_key}", "string"))
    )
    fields = parsed.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()).select("key", "value"))
    kind = _kind(F.schema_of_variant("value"))
    return fields.select(
        "feed",
        "batch_no",
        "rec",
        F.col("key").alias("name"),
        kind.alias("kind"),
        F.when(kind.isNotNull(), F.to_json("value")).alias("value"),
    )


def catalogue(fields: DataFrame) -> DataFrame:
    """Per file and field the types seen (at most six, sorted; empty if only JSON nulls)."""
    return fields.groupBy("feed", "batch_no", "name").agg(
        F.sort_array(F.collect_set("kind")).alias("kinds"), F.count(F.lit(1)).alias("records")
    )


def lifespans(cat: DataFrame) -> DataFrame:
    """Islands of consecutive files per producer, field and type set: first and last file of each."""
    w = Window.partitionBy("feed", "name", "kind").orderBy("batch_no")
    typed = cat.withColumn("kind", F.array_join("kinds", "|"))
    began = typed.withColumn(
        "began", (F.col("batch_no") - F.coalesce(F.lag("batch_no").over(w), F.lit(-2)) > 1).cast("int")
    )
    return (
        began.withColumn("island", F.sum("began").over(w))
        .groupBy("feed", "name", "kind", "island")
        .agg(F.min("batch_no").alias("first_batch"), F.max("batch_no").alias("last_batch"), F.sum("records").alias("records"))
        .drop("island")
    )


def changes(batches: DataFrame, record_key: str = "rec_no") -> DataFrame:
    """Every added, removed, renamed and retyped field: feed, batch_no, change, old_name, new_name.

    A file is compared with the file of the same feed whose batch_no is one less; without such a
    file there are no changes. A file of which no record is readable has no fields. A field whose
    values are all JSON null has no type and is never retyped. Rows without feed or batch_no
    belong to no file. Repeated records count once. An empty table gives no rows.
    """
    known = batches.filter(F.col("feed").isNotNull() & F.col("batch_no").isNotNull())
    fields = written(record_fields(known, record_key), "fields")  # parsed once, read four times below
    cat = written(catalogue(fields), "catalogue")
    files = known.select("feed", "batch_no").distinct()
    follows = files.join(
        files.select("feed", (F.col("batch_no") + 1).alias("batch_no")), ["feed", "batch_no"], "left_semi"
    )

    spans = Window.partitionBy("feed", "name").orderBy("batch_no")
    ahead, behind = F.lead("batch_no").over(spans), F.lag("batch_no").over(spans)
    edges = cat.select(
        "feed",
        "name",
        "batch_no",
        "kinds",
        F.lag("kinds").over(spans).alias("kinds_before"),
        (F.coalesce(behind, F.lit(-2)) == F.col("batch_no") - 1).alias("continues"),
        (F.coalesce(ahead, F.lit(-2)) == F.col("batch_no") + 1).alias("goes_on"),
    )
    starts = edges.filter(~F.col("continues")).select("feed", "batch_no", "name", "kinds")
    ends = edges.filter(~F.col("goes_on")).select("feed", (F.col("batch_no") + 1).alias("batch_no"), "name", "kinds")
    starts, ends = (x.join(follows, ["feed", "batch_no"], "left_semi") for x in (starts, ends))
    retyped = edges.filter(
        F.col("continues") & (F.size("kinds") > 0) & (F.size("kinds_before") > 0) & (F.col("kinds") != F.col("kinds_before"))
    ).select(
        "feed", "batch_no", F.lit("retyped").alias("change"), F.col("name").alias("old_name"), F.col("name").alias("new_name")
    )

    # Values that records present in both files have in a field that ends and in one that starts.
    values = fields.filter(F.col("rec").isNotNull() & F.col("kind").isNotNull())
    old = (
        values.withColumn("batch_no", F.col("batch_no") + 1)
        .join(ends.select("feed", "batch_no", "name"), ["feed", "batch_no", "name"], "left_semi")
        .distinct()
        .select("feed", "batch_no", "rec", F.col("name").alias("old_name"), F.col("kind").alias("k"), F.col("value").alias("v"))
    )
    new = (
        values.join(starts.select("feed", "batch_no", "name"), ["feed", "batch_no", "name"], "left_semi")
        .distinct()
        .withColumnRenamed("name", "new_name")
    )
    alias = F.create_map(*[F.lit(x) for c, (_, names) in ALIASES.items() for n in names for x in (n, c)])
    pairs = (
        old.join(new, ["feed", "batch_no", "rec"])
        .groupBy("feed", "batch_no", "old_name", "new_name")
        .agg(
            F.bool_and((F.col("k") == F.col("kind")) & (F.col("v") == F.col("value"))).alias("same"),
            F.count(F.lit(1)).alias("records"),
            F.countDistinct("value").alias("different"),
        )
        .filter("same")
        .withColumn(
            "known", F.coalesce(F.try_element_at(alias, "old_name") == F.try_element_at(alias, "new_name"), F.lit(False))
        )
    )
    order = [F.desc("known"), F.desc("different"), F.desc("records")]
    by_old = Window.partitionBy("feed", "batch_no", "old_name").orderBy(*order, "new_name")
    by_new = Window.partitionBy("feed", "batch_no", "new_name").orderBy(*order, "old_name")
    renamed = (
        pairs.withColumn("a", F.row_number().over(by_old))
        .withColumn("b", F.row_number().over(by_new))
        .filter("a = 1 AND b = 1")
        .select("feed", "batch_no", F.lit("renamed").alias("change"), "old_name", "new_name")
    )
    renamed = written(renamed, "renamed")

    def unpaired(side: DataFrame, change: str, paired: str) -> DataFrame:
        rest = side.join(
            renamed.select("feed", "batch_no", F.col(paired).alias("name")), ["feed", "batch_no", "name"], "left_anti"
        )
        none = F.lit("")
        names = (F.col("name"), none) if change == "removed" else (none, F.col("name"))
        return rest.select("feed", "batch_no", F.lit(change).alias("change"), names[0].alias("old_name"), names[1].alias("new_name"))

    return (
        retyped.unionByName(renamed)
        .unionByName(unpaired(ends, "removed", "old_name"))
        .unionByName(unpaired(starts, "added", "new_name"))
    )


def derived_aliases(batches: DataFrame, record_key: str = "rec_no") -> dict[str, list[str]]:
    """Names of each quantity: those of ALIASES, then the others that `changes` finds renamed to or from one of its names.

    Renamings are followed from name to name. A name that is renamed to or from names of several
    quantities belongs to the one with more than half of its renamings, or to none.
    """
    rows = changes(batches, record_key).filter("change = 'renamed'").groupBy("old_name", "new_name").count().collect()
    quantity = {n: q for q, (_, names) in ALIASES.items() for n in names}
    listed = quantity.keys() | {record_key, "url"}
    while True:
        votes: dict[str, Counter] = defaultdict(Counter)
        for r in rows:
            for name, other in ((r.old_name, r.new_name), (r.new_name, r.old_name)):
                if name not in listed and name not in quantity and other in quantity:
                    votes[name][quantity[other]] += r["count"]
        best = {n: v.most_common(1)[0] for n, v in votes.items()}
        found = {n: q for n, (q, k) in best.items() if 2 * k > votes[n].total()}
        if not found:
            break
        quantity |= found
    return {q: [*names, *sorted(n for n, x in quantity.items() if x == q and n not in listed)] for q, (_, names) in ALIASES.items()}


def consistent_table(batches: DataFrame, json: bool = False) -> DataFrame:
    """All readable records in one table: a column per quantity of the alias table, casts by it.

    Names outside the alias table that were renamed to or from a name in it go to its column
    (`derived_aliases`). Times come in microseconds: ISO strings and seconds are converted. Scores
    sent as whole numbers are ten-thousandths, durations sent as whole numbers milliseconds;
    durations as text may end in s, signatures as text may be hexadecimal. All other fields stay, as
    JSON text, in the map `others`, with `json` as one JSON object that keeps their types, sorted by
    name. A value that its cast can't take, or that differs from the one in its column because the
    record has the quantity under two names, stays in `others` too. Repeated rows of raw_batches
    stay repeated.
    """
    names = derived_aliases(batches)
    v = (
        batches.withColumn("v", F.try_parse_json("payload"))
        .filter(F.col("v").isNotNull() & F.schema_of_variant("v").startswith("OBJECT"))
        .withColumn("fields", F.from_json(F.to_json("v"), "map<string,variant>"))
    )
    names = {"rec_no": ["rec_no"], "url": ["url"], **names}
    known = [(n, q) for q, of in names.items() for n in of]
    at = {n: i for i, (n, _) in enumerate(known)}
    # One step each for values, texts and types, casts, columns: every expression is evaluated once.
    v = v.select("*", *[F.try_element_at("fields", F.lit(n)).alias(f"_v{i}") for n, i in at.items()])
    texts = [F.try_variant_get(f"_v{i}", "$", "string").alias(f"_t{i}") for i in at.values()]
    v = v.select("*", *texts, *[_kind(F.schema_of_variant(f"_v{i}")).alias(f"_k{i}") for i in at.values()])
    kinds = {"rec_no": "bigint", "url": "string", **{q: kind for q, (kind, _) in ALIASES.items()}}
    v = v.select("*", *[_cast(F.col(f"_t{at[n]}"), F.col(f"_k{at[n]}"), q, kinds[q]).alias(f"_c{at[n]}") for n, q in known])
    v = v.select("*", *[F.coalesce(*[F.col(f"_c{at[n]}") for n in of]).alias(q) for q, of in names.items()])
    # A field needs no place in others if it is JSON null or its column holds its value.
    taken = [F.when(F.col(f"_t{at[n]}").isNull() | (F.col(f"_c{at[n]}") == F.col(q)), n) for n, q in known]
    everything = F.col("fields") if json else F.from_json(F.to_json("v"), "map<string,string>")
    v = v.withColumn("_taken", F.array_compact(F.array(*taken)))
    others = F.map_filter(everything, lambda k, _: ~F.array_contains("_taken", k))
    return v.select("raw_id", "feed", "batch_no", *names, (F.to_json(others) if json else others).alias("others"))


def _cast(raw: Column, came: Column, quantity: str, kind: str) -> Column:
    """The cast of one field's text by the type in which it came."""
    number = raw.try_cast("double")
    if quantity in ("crawl_timestamp", "file_time"):
        iso = F.unix_micros(F.to_utc_timestamp(raw.try_cast("timestamp"), "UTC"))
        whole = raw.try_cast("bigint")
        return F.when(came == "fraction", F.round(number * 1000000).cast("bigint")).otherwise(F.coalesce(whole, iso))
    if quantity == "score":
        return F.when(came == "whole", number / 10000).otherwise(number)
    if quantity in ("crawl_time", "dns_time"):
        seconds = F.regexp_extract(raw, r"^\s*([0-9.]+)\s*s$", 1).try_cast("double")
        return F.when(came == "whole", number / 1000).otherwise(F.coalesce(number, seconds))
    if quantity == "is_truncated":
        return F.when(raw.isin("true", "1"), True).when(raw.isin("false", "0"), False)
    if quantity == "content_type":
        listed = F.array_join(F.from_json(raw, "array<string>"), "; ")
        return F.when(came == "list", listed).otherwise(raw)
    if quantity == "simhash":
        # As text: 15 or 16 digits are hexadecimal with leading zeros, in decimals all but 1 % of signatures have more.
        padded = raw.rlike("^[0-9A-Fa-f]{15,16}$")
        hexadecimal = F.when(raw.rlike("^[0-9A-Fa-f]{1,16}$"), F.conv(raw, 16, -10).try_cast(kind))
        return F.when((came == "string") & padded, hexadecimal).otherwise(
            F.coalesce(raw.try_cast(kind), F.when(came == "string", hexadecimal))
        )
    return raw.try_cast(kind)

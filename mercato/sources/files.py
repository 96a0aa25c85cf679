"""File ingestion of the silver feeds (SRC-01..06, SRC-09).

Each reader applies the feed's steps as Spark operations: list the folder
with a suffix filter, parse, keep/rename columns, drop echoed headers and
blank keys, then type the columns.  Typing uses ``try_cast``: a cell that
does not parse becomes NULL and its row is routed to the ``rejects``
DataFrame instead of failing the load.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.functions.exprs import PROMO_EN, remap, rename_if_present
from mercato.sources import folders

# Column names and types of the feeds.
WEATHER_RAW = ["date", "city", "region", "temp_max_c", "temp_min_c", "precipitation_mm",
               "wind_kmh", "is_sunny", "weather_label"]
WEATHER_RENAMES = {"temp_max_c": "max_temperature_c", "temp_min_c": "min_temperature_c",
                   "precipitation_mm": "rainfall_mm", "wind_kmh": "wind_speed_kmh",
                   "weather_label": "weather_condition"}
WEATHER_TYPES = {"date": "date", "city": "string", "region": "string", "max_temperature_c": "double",
                 "min_temperature_c": "double", "rainfall_mm": "double", "wind_speed_kmh": "double",
                 "is_sunny": "boolean", "weather_condition": "string"}

PROMO_TYPES = {"promo_id": "bigint", "promo_name": "string", "start_date": "date", "end_date": "date",
               "category": "string", "discount_pct": "double", "traffic_boost": "double",
               "is_national": "boolean", "budget_eur": "bigint", "communication_type": "string"}

COMPETITOR_TYPES = {"snapshot_month": "string", "product_id": "bigint", "product_name": "string",
                    "category": "string", "competitor": "string", "competitor_price": "double",
                    "our_price": "double", "price_gap_pct": "double", "is_cheaper": "boolean",
                    "source": "string"}


@dataclass
class Loaded:
    rows: DataFrame      # typed rows that parsed
    rejects: DataFrame   # raw rows with at least one cell that did not parse


def typed(df: DataFrame, types: dict[str, str]) -> Loaded:
    """SRC-06: select then type; unparseable non-empty cells reject the row."""
    cols = [c for c in types if c in df.columns]
    raw = df.select(*[F.col(c).cast("string").alias(c) for c in cols])
    conv = {c: F.trim(F.col(c)).try_cast(types[c]) if types[c] != "string" else F.col(c) for c in cols}
    bad = reduce(lambda a, b: a | b, [F.col(c).isNotNull() & (F.trim(F.col(c)) != "") & conv[c].isNull()
                                      for c in cols if types[c] != "string"], F.lit(False))
    flagged = raw.withColumn("_bad", bad)
    rows = flagged.where(~F.col("_bad")).select(*[conv[c].alias(c) for c in cols])
    rejects = flagged.where(F.col("_bad")).drop("_bad")
    return Loaded(rows, rejects)


def read_weather(spark: SparkSession, folder: str, suffix: str = "*.json") -> Loaded:
    """SRC-01/02 + PRJ-02: daily files, each a JSON array of records; keep
    files matching ``suffix`` only; one row per record; rename to silver
    names; type.  Text that is no JSON, and records without date or city,
    are rejects."""
    schema = ", ".join(f"{c} string" for c in [*WEATHER_RAW, "_corrupt"])
    df = (spark.read.schema(schema).option("multiLine", True).option("pathGlobFilter", suffix)
          .option("recursiveFileLookup", True).option("encoding", "UTF-8")
          .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(folder))
    broken = F.col("_corrupt").isNotNull() | F.col("date").isNull() | F.col("city").isNull()
    good = typed(rename_if_present(df.where(~broken).drop("_corrupt"), WEATHER_RENAMES), WEATHER_TYPES)
    bad = rename_if_present(df.where(broken), WEATHER_RENAMES)
    return Loaded(good.rows, good.rejects.unionByName(bad, allowMissingColumns=True))


def read_promotions(spark: SparkSession, path: str, as_of: Column) -> Loaded:
    """SRC-03 + PRJ-09: one UTF-8 CSV with header; typed; promo names in
    English; is_active recomputed for ``as_of`` (overwriting the file's
    own is_active column instead of colliding with it)."""
    df = spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
    t = typed(df, PROMO_TYPES)
    rows = (t.rows.withColumn("promo_name", remap("promo_name", PROMO_EN))
            .withColumn("is_active", as_of.between(F.col("start_date"), F.col("end_date"))))
    return Loaded(rows, t.rejects)


def read_competitor(spark: SparkSession, folder: str) -> Loaded:
    """SRC-04/05: monthly CSVs combined by column name, whatever the order of
    a file's columns; a quoted field never spans lines; echoed header rows
    and blank keys are dropped before typing (the key is read as text).

    Files are read as lines with their path; a file's header is the first of
    its lines that names the key (one short row per file, stored and joined back), and
    each file is parsed by the layout of its header; of a name that a header
    repeats the first column counts.  The lines of a file without header
    are rejects, whole in the column ``line``."""
    text = spark.read.option("pathGlobFilter", "*.csv").text(folder)
    parts = [c for c in text.columns if c != "value"]  # a month may be the folder's, not the file's
    lines = text.select(F.col("_metadata.file_path").alias("path"), *[F.col(c).cast("string").alias(f"in_{c}") for c in parts],
                        F.translate("value", "\r\ufeff", "").alias("value"))
    bare_names = lambda c: F.translate(c, '" ', "")
    lines = lines.withColumn("is_header", F.concat(F.lit(","), bare_names("value"), F.lit(",")).contains(",product_id,"))
    names = F.split(bare_names(F.min("value")), ",")
    places = F.array(*[F.array_position("names", F.lit(c)).cast("int") - 1 for c in COMPETITOR_TYPES])
    # stored, so that its size is known before the lines are joined to it
    layouts = folders.stored(lines.where("is_header").groupBy("path").agg(names.alias("names")).select("path", places.alias("places")),
                             "layouts")
    every = lines.where(~F.col("is_header") & (F.trim("value") != "")).join(layouts, "path", "left")
    rows = every.where(F.col("places").isNotNull())
    # a quoted field keeps its commas: cut at commas outside quotes, then unquote; lines without quotes are cut at once
    quoted = F.transform(F.split("value", ',(?=(?:[^"]*"[^"]*")*[^"]*$)'),
                         lambda v: F.regexp_replace(F.regexp_replace(F.trim(v), '^"|"$', ""), '""', '"'))
    cells = F.when(F.col("value").contains('"'), quoted).otherwise(F.transform(F.split("value", ","), lambda v: F.trim(v)))
    # cut once for each line: what is asked of the cells below isn't asked of the line again
    cut = rows.select("places", *[f"in_{c}" for c in parts], F.explode(F.array(cells)).alias("cells"))
    place = {c: F.col("places")[i] for i, c in enumerate(COMPETITOR_TYPES)}
    value = lambda c: F.nullif(F.get("cells", place[c]), F.lit(""))
    df = cut.select(*[(F.coalesce(value(c), F.col(f"in_{c}")) if c in parts else value(c)).alias(c) for c in COMPETITOR_TYPES])
    key = F.trim(F.col("product_id"))
    good = typed(df.where(key.isNotNull() & (key != "")), COMPETITOR_TYPES)
    bare = every.where(F.col("places").isNull()).select(*[F.col(f"in_{c}").alias(c) for c in parts if c in COMPETITOR_TYPES],
                                                        F.col("value").alias("line"))
    return Loaded(good.rows, good.rejects.unionByName(bare, allowMissingColumns=True))


def write_weather_feed(weather: DataFrame, folder: str) -> None:
    """Publish silver weather rows as the raw feed: one file per day holding
    a JSON array of that day's records under the raw field names (one
    group per day, bounded by the number of cities)."""
    raw = {v: k for k, v in WEATHER_RENAMES.items()}
    recs = weather.select(*[F.col(c).alias(raw.get(c, c)) for c in weather.columns])
    recs = recs.withColumn("date", F.col("date").cast("string"))
    days = recs.groupBy(F.col("date").alias("day")).agg(
        F.to_json(F.sort_array(F.collect_list(F.struct(*WEATHER_RAW)))).alias("value"))
    days.repartition("day").write.partitionBy("day").text(folder)

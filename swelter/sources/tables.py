"""Readers of daily tables, places, stations and dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from swelter.sources.hourly import number

# Census state codes by FIPS number, provinces by StatCan number, legal suffixes of place names, European countries and box.
STATES = dict(zip("01 04 05 06 08 09 10 11 12 13 16 17 18 19 20 21 22 23 24 25 26 27 28 29 30 31 32 33 34 35 36 37 38 39 40 41 42 44 45 46 47 48 49 50 51 53 54 55 56".split(), "AL AZ AR CA CO CT DE DC FL GA ID IL IN IA KS KY LA ME MD MA MI MN MS MO MT NE NV NH NJ NM NY NC ND OH OK OR PA RI SC SD TN TX UT VT VA WA WV WI WY".split(), strict=True))
EXCLUDED_STATES = ("02", "15")
PROVINCES = dict(zip("10 11 12 13 24 35 46 47 48 59 60 61 62".split(), "NL PE NS NB QC ON MB SK AB BC YT NT NU".split(), strict=True))
SUFFIXES = ("city", "town", "village", "borough", "municipality", "CDP", "urban county", "unified government", "consolidated government", "metro government", "metropolitan government")
SUFFIX = rf"(?i)\s+({'|'.join(SUFFIXES)})$"
EUROPE = "AT BE BG HR CY CZ DK EE FI FR DE GR HU IE IT LV LT LU MT NL PL PT RO SK SI ES SE GB CH".split()
EUROPE_BOX = {"lat": (34.0, 72.0), "lng": (-25.0, 45.0)}
GEONAMES = {1: "name", 4: "lat", 5: "lng", 6: "feature_class", 8: "country_code", 10: "admin1_code", 14: "population", 16: "dem_m", 17: "timezone"}
PRESSURES = ("station_level_pressure", "sea_level_pressure", "altimeter")
DIMENSIONS = {
    "locations": "location_id int, city string, state string, lat double, lng double",
    "gmst_observations": "year int, anomaly double, anomaly_lo double, anomaly_hi double, source_version string",
    "gmst_scenarios": "scenario string, year int, anomaly double, anomaly_lo double, anomaly_hi double, sigma_g double",
    "forecast_station_groups": "location_id int, station_group string",
    "forecast_interval_calibration": "metric string, calibration_factor double",
}
#: Columns of the daily files, in the widest types they were ever written with; files of any kind may lack some.
_CORE = "location_id long, date date, wetbulb double, wetbulb_avg double, source string, observed_hours long"
_STATION = f"{_CORE}, station_id string, reference_station_id string, station_distance_km double, station_elevation_difference_m double, station_quality string, homogenization_method string, homogenization_overlap_days long, wetbulb_adjustment double, wetbulb_avg_adjustment double"
#: Kinds of daily files: the names of their files, their columns, and the source of rows that name none.
KINDS = {
    "station": ("wetbulb_batch_*.parquet", _STATION, "isd"),
    "eccc": ("wetbulb_eccc_batch_*.parquet", _STATION, "eccc"),
    "fill": ("wetbulb_fill_batch_*.parquet", _CORE, "nldas"),
}


def read_daily(spark: SparkSession, root: str, *, start_year: int | None = None, end_year: int | None = None, kinds=("station", "eccc", "fill"), pattern: str | None = None) -> DataFrame:
    """The daily files under ``year=...`` folders, with the union of the kinds' columns; what a file lacks is null.

    Each kind is a scan of its own files with a declared schema, so no footers are merged and other kinds are not opened; years are chosen
    by folder. Rows without a source get that of their kind. ``pattern`` reads files of other names, all as station files."""
    out = None
    for glob, schema, known in [(pattern, _STATION, "isd")] if pattern else [KINDS[k] for k in kinds]:
        df = spark.read.schema(schema).option("pathGlobFilter", glob).parquet(root)
        if "year" not in df.columns:  # no file of this kind
            df = df.withColumn("year", F.lit(None).cast("int"))
        if start_year is not None:
            df = df.where(F.col("year") >= start_year)
        if end_year is not None:
            df = df.where(F.col("year") <= end_year)
        df = df.withColumns({"location_id": F.col("location_id").cast("int"), "source": F.coalesce("source", F.lit(known)), "year": F.col("year").cast("int")})
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def clean_place_name(name: Column) -> Column:
    """Without bracketed parts and one legal suffix."""
    plain = F.trim(F.regexp_replace(F.trim(F.regexp_replace(name, r"\([^)]*\)", "")), SUFFIX, ""))
    return F.when(plain != "", plain).otherwise(F.trim(name))


def _mapped(c: Column, table: dict[str, str]) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for kv in table.items() for x in kv)), c)


def read_places_us(estimates: DataFrame, gazetteer: DataFrame, *, summary_levels=(162,), population: str = "POPESTIMATE2023", by=()) -> DataFrame:
    """Census places of the contiguous states with the points of the gazetteer; the last row of a place wins (by ``row`` if there is one).

    ``by`` names columns of both tables that tell files apart in which place numbers are given anew; a place stands once in each."""
    state, place = F.lpad(F.col("STATE"), 2, "0"), F.lpad(F.col("PLACE"), 5, "0")
    rows = estimates.where(number(F.col("SUMLEV")).isin(*map(float, summary_levels)) & ~state.isin(*EXCLUDED_STATES))
    rows = rows.select(F.concat(state, place).alias("geoid"), clean_place_name(F.col("NAME")).alias("city"), _mapped(state, STATES).alias("state"), number(F.col(population)).cast("long").alias("population"), *by, *(["row"] if "row" in estimates.columns else []))
    last = Window.partitionBy("geoid", *by).orderBy(F.desc("row") if "row" in rows.columns else F.desc("population"), "city")
    rows = rows.where("population is not null and state is not null").withColumn("_r", F.row_number().over(last)).where("_r = 1")
    points = gazetteer.select(F.lpad(F.col("GEOID"), 7, "0").alias("geoid"), number(F.col("INTPTLAT")).alias("lat"), number(F.col("INTPTLONG")).alias("lng"), *by).where("lat is not null and lng is not null").dropDuplicates(["geoid", *by])
    return rows.join(points, ["geoid", *by]).select(F.concat(F.lit("US"), "geoid").alias("place_id"), "city", "state", F.lit("US").alias("country"), "population", "lat", "lng")


def read_places_ca(csd: DataFrame, *, types=("C", "CV", "CY", "DM", "M", "MD", "MU", "RGM", "T", "TV", "V", "VL")) -> DataFrame:
    """Municipal census subdivisions of Canada."""
    rows = csd.where(F.col("CSDtype").isin(*types))
    return rows.select(F.concat(F.lit("CA"), F.col("CSDuid")).alias("place_id"), clean_place_name(F.col("CSDname")).alias("city"), _mapped(F.lpad(F.col("PRuid"), 2, "0"), PROVINCES).alias("state"), F.lit("CA").alias("country"), number(F.col("CSDpop_2021")).cast("long").alias("population"), number(F.col("lat")).alias("lat"), number(F.col("lng")).alias("lng")).dropna()


def read_geonames(spark: SparkSession, path: str, *, region: str | None = None) -> DataFrame:
    """Populated places of a headerless dump; region "europe" keeps the countries and the box."""
    raw = spark.read.option("sep", "\t").option("quote", "").csv(path)
    raw = raw.select(*(F.col(f"_c{k}").alias(c) for k, c in GEONAMES.items())).where("feature_class = 'P'")
    out = raw.select("name", *(number(F.col(c)).alias(c) for c in ("lat", "lng")), "country_code", "admin1_code", number(F.col("population")).cast("long").alias("population"), number(F.col("dem_m")).alias("dem_m"), "timezone")
    if region == "europe":
        return out.where(F.col("country_code").isin(*EUROPE) & F.col("lat").between(*EUROPE_BOX["lat"]) & F.col("lng").between(*EUROPE_BOX["lng"]))
    return out.dropna(subset=["lat", "lng", "dem_m", "timezone"])


def station_coverage_scores(inventory: DataFrame, *, by_year: bool = False) -> DataFrame:
    """Per station (and year) the least covered of temperature, dew point and the best pressure, from rows (file, stations)."""
    v = inventory.select("file", F.explode("stations").alias("s")).select("file", F.explode("s.dataTypes").alias("d")).select("file", F.col("d.id").alias("id"), F.col("d.coverage").cast("double").alias("c"))
    best = lambda *ids: F.coalesce(F.max(F.when(F.col("id").isin(*ids), F.col("c"))), F.lit(0.0))
    per = v.groupBy("file").agg(F.least(best("temperature"), best("dew_point_temperature"), best(*PRESSURES)).alias("score")).where("score > 0")
    name = r"GHCNh_(.*)_(\d+)\.json$"
    keyed = per.select(F.regexp_extract("file", name, 1).alias("station_id"), F.regexp_extract("file", name, 2).try_cast("int").alias("year"), "score")
    return keyed.groupBy("station_id", *(["year"] if by_year else [])).agg(F.max("score").alias("score"))


def read_station_inventory(spark: SparkSession, path: str, *, style: str = "isd", bbox: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Stations with position, elevation and years: "isd" reads the history CSV, "geojson" pages of features."""
    if style == "isd":
        raw = spark.read.option("header", True).csv(path)
        year = lambda c: F.substring(F.col(c), 1, 4).try_cast("int")
        out = raw.select(F.concat("USAF", "WBAN").alias("station_id"), number(F.col("LAT")).alias("lat"), number(F.col("LON")).alias("lon"), number(F.col("`ELEV(M)`")).alias("elev_m"), year("BEGIN").alias("begin_year"), year("END").alias("end_year"))
    elif style == "geojson":
        shape = "features array<struct<geometry:struct<coordinates:array<double>>,properties:struct<STN_ID:string,STATION_NAME:string,HAS_HOURLY_DATA:string,ELEVATION:string,HLY_FIRST_DATE:string,HLY_LAST_DATE:string>>>"
        f = spark.read.schema(shape).option("multiLine", True).json(path).select(F.explode("features").alias("f")).where("f.properties.HAS_HOURLY_DATA = 'Y'")
        at = lambda k: F.get(F.col("f.geometry.coordinates"), k)
        year = lambda c: F.year(F.col(f"f.properties.{c}").try_cast("timestamp_ntz"))
        out = f.select(F.col("f.properties.STN_ID").alias("station_id"), at(1).alias("lat"), at(0).alias("lon"), number(F.col("f.properties.ELEVATION")).alias("elev_m"), year("HLY_FIRST_DATE").alias("begin_year"), year("HLY_LAST_DATE").alias("end_year")).dropna()
    else:
        raise ValueError(f"style {style!r} is not known")
    out = out.dropna(subset=["lat", "lon", "elev_m"])
    if bbox is not None:
        out = out.where(F.col("lat").between(bbox[0], bbox[1]) & F.col("lon").between(bbox[2], bbox[3]))
    return out


def read_dimensions(spark: SparkSession, root: str, names=tuple(DIMENSIONS)) -> dict[str, DataFrame]:
    """The small tables by name, with declared types; a location's id is named ``id``."""
    out = {n: spark.read.option("header", True).schema(DIMENSIONS[n]).csv(f"{root}/{n}.csv") for n in names}
    if "locations" in out:
        out["locations"] = out["locations"].withColumnRenamed("location_id", "id")
    return out

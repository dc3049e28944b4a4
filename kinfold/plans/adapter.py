"""Business entities made from the test tables: one text of SQL expressions for Spark and DuckDB.

S1 has a record for every customer; S2 has each customer again, as another registry might write
it (every fifth is a different business there); S3 has a record for every supplier, which is
the customer of the same number in a third spelling (every fourth is not), and one for every
part. Names and addresses take every form that normalization knows: legal forms long and short,
aliases, ids in brackets, honorifics, accents, postal codes and regions of three countries and
none, landmarks, abbreviations, blank fields. Nothing is cut.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.operators.records import normalized

FRONT = ["Amber", "Birch", "Cobalt", "Delta", "Élan", "Fédération", "Granite", "Harbour", "Indigo", "Jasmine", "Kestrel", "Lumière", "Maple", "Nimbus", "Opaline", "Prairie", "Quartz", "Réseau", "Saffron", "Tamarind", "Umbra", "Verdant", "Willow", "Zénith"]
BACK = ["Bakers", "Cartage", "Dyeworks", "Exports", "Foundry", "Gardens", "Hosiery", "Ironmongers", "Jewellers", "Knitwear", "Logistics", "Millers", "Nurseries", "Optics", "Printers", "Quarries", "Roasters", "Shipping", "Textiles", "Upholstery", "Vintners", "Weavers", "Xylophones", "Yachts"]
TRADE = ["Trading", "India", "and Partners", "Services", "du Nord", "Group", "(Overseas)", "of Salem"]
#: Legal forms, and how another registry spells them.
LONG = ["Private Limited", "Public Limited", "Limited Liability Company", "Limited Liability Partnership", "Professional Limited Liability Company", "Société à responsabilité limitée", "Société par actions simplifiée unipersonnelle", "Société par actions simplifiée", "Entreprise unipersonnelle à responsabilité limitée", "Société civile immobilière", "Société anonyme", "et Fils", "et Frères", "Corporation", "Incorporated", "Limited", "Company", "Compagnie"]
SHORT = ["Pvt. Ltd.", "Pub Ltd", "L.L.C.", "LLP", "P.L.L.C.", "S.A.R.L.", "SASU", "S.A.S.", "E.U.R.L.", "SCI", "S.A.", "& Fils", "& frères", "CORP.", "Inc", "Ltd", "Co.", "Cie"]
ALIASES = ["dba", "d/b/a", "aka", "a/k/a", "trading as", "t/a", "formerly known as", "fka", "f/k/a", "née"]
HONORIFICS = ["M/s", "M/s.", "Shri", "Sri.", "Dr.", "Mr", "Mrs."]

STREETS = ["Cedar", "Station", "Mill", "Church", "Lake View", "Gandhi", "Victor Hugo", "Côte Fleurie", "Temple", "Harbour", "Nehru", "Foch"]
WAYS = ["Road", "Street", "Avenue", "Boulevard", "Drive", "Lane", "Court", "Highway", "Square", "Place"]
WAYS_SHORT = ["Rd", "St.", "Ave", "Blvd", "Dr", "Ln", "Ct", "Hwy", "Sq", "Pl"]
US_CITIES = ["Tyler", "Boise", "Salem", "Dayton", "Eugene", "Fargo", "Macon", "Provo", "Tulsa"]
US_STATES = ["TX", "ID", "OR", "OH", "ND", "GA", "UT", "OK", "IA", "ME", "NY"]
IN_CITIES = ["Pune", "Mysore", "Nagpur", "Indore", "Surat", "Kochi", "Ranchi"]
IN_STATES = ["Maharashtra", "Karnataka", "Madhya Pradesh", "Gujarat", "Kerala", "Jharkhand", "Tamil Nadu", "New Delhi"]
FR_CITIES = ["Dunkerque", "Saint-Nazaire", "Orléans", "Nîmes", "Besançon", "Le Havre", "Ajaccio"]
FR_REGIONS = ["Hauts-de-France", "Pays de la Loire", "Centre-Val de Loire", "Occitanie", "Normandie", "Corse", "Île-de-France", "Provence-Alpes-Côte d Azur"]
LANDMARKS = ["Near Old Clock Tower", "Opp. City Hall", "Opposite Bus Stand", "Behind M.C Quarters", "Beside Grain Market", "Next to Fire Station", "In front of St. Mary Church", "Adjacent to Water Tank", "Above Corner Shop", "Below Railway Bridge"]
UNITS = ["Apt 4", "Ste 210", "2nd Floor", "Bldg 7", "Sector 12", "Unit 3B", "P.O. Box 88", "Phase 1"]


def pick(words: list[str], index: str) -> str:
    return f"split_part('{'|'.join(words)}', '|', CAST(({index}) % {len(words)} AS INT) + 1)"


def over(k: str, n: int) -> str:
    return f"CAST(floor(({k}) / {n}) AS BIGINT)"


def text(x: str) -> str:
    return f"CAST({x} AS STRING)"


def country(k: str) -> str:
    return f"CASE WHEN ({k}) % 17 = 5 THEN '' ELSE {pick(['US', 'India', 'France', 'US'], k)} END"


def core_name(k: str, forms: list[str], swapped: bool = False) -> str:
    front, back = pick(FRONT, f"({k}) * 7"), pick(BACK, over(k, 24))
    words = f"{back} || ' ' || {front}" if swapped else f"{front} || ' ' || {back}"
    return f"{words} || CASE WHEN ({k}) % 3 = 0 THEN ' ' || {pick(TRADE, over(k, 3))} ELSE '' END || ' ' || {pick(forms, f'({k}) * 5')}"


def other_name(k: str) -> str:
    """A name in one of eight manners of another registry."""
    name = core_name(k, SHORT)
    return f"""CASE CAST(({over(k, 5)}) % 8 AS INT)
      WHEN 0 THEN {name}
      WHEN 1 THEN {pick(BACK, f'({k}) * 11')} || ' Holdings ' || {pick(ALIASES, over(k, 40))} || ' ' || {name}
      WHEN 2 THEN {name} || ' (ID: ' || {text(k)} || ')'
      WHEN 3 THEN {pick(HONORIFICS, over(k, 40))} || ' ' || {name}
      WHEN 4 THEN upper({name})
      WHEN 5 THEN {core_name(k, SHORT, True)}
      WHEN 6 THEN '[' || {name} || ']'
      ELSE {name} || ' [#' || {text(k)} || ']' END"""


def address(k: str, ways: list[str], pin: str = "true") -> str:
    """An address as its country writes it; `pin`: whether the postal code is there."""
    street = f"{pick(STREETS, over(k, 3))} || ' ' || {pick(ways, f'({k}) * 3')}"
    number = text(f"1 + ({k}) * 37 % 990")
    mark = f"CASE WHEN ({k}) % 4 = 1 THEN ', ' || {pick(LANDMARKS, over(k, 4))} ELSE '' END"
    unit = f"CASE WHEN ({k}) % 5 = 2 THEN ', ' || {pick(UNITS, over(k, 5))} ELSE '' END"
    zip_ = lambda base: f"CASE WHEN {pin} THEN ' ' || {text(f'{base} + ({k}) * 7 % 800')} ELSE '' END"
    us = f"{number} || ' ' || {street} || {unit} || ', ' || {pick(US_CITIES, over(k, 7))} || ', ' || {pick(US_STATES, k)} || {zip_('70100')} || CASE WHEN ({k}) % 6 = 0 AND {pin} THEN '-' || {text(f'1000 + ({k}) % 9000')} ELSE '' END"
    us_back = f"{pick(US_STATES, k)} || ', ' || {pick(US_CITIES, over(k, 7))} || ' City, ' || {number} || ' ' || {street} || {unit}"
    india = f"CASE WHEN ({k}) % 8 < 3 THEN 'Plot No. ' WHEN ({k}) % 8 < 5 THEN 'H.No ' WHEN ({k}) % 8 < 6 THEN 'S. No ' ELSE '#' END || {number} || '/' || {text(f'({k}) % 9')} || ', ' || {street} || {mark} || ', ' || {pick(IN_CITIES, over(k, 7))} || ', ' || {pick(IN_STATES, k)} || {zip_('411000')}"
    france = f"{number} || CASE WHEN ({k}) % 9 = 0 THEN ' bis' ELSE '' END || ' ' || {pick(['Rue', 'Av', 'Bd', 'Chem', 'Imp', 'All'], over(k, 2))} || ' ' || {pick(STREETS, over(k, 3))} || {mark} || ',' || {zip_('44000')} || ' ' || {pick(FR_CITIES, over(k, 7))} || ', ' || {pick(FR_REGIONS, k)}"
    none = f"{number} || ' ' || {street} || ', Springfield ' || {text(f'30000 + ({k}) % 500')} || ', Ghana'"
    return f"""CASE {country(k)} WHEN 'US' THEN CASE WHEN ({k}) % 11 = 3 THEN {us_back} ELSE {us} END
      WHEN 'India' THEN {india} WHEN 'France' THEN {france} ELSE {none} END"""


#: Columns of the four kinds of records, by the number k: source, id, k, pos, name, address.
_own = "CASE WHEN k % 5 = 0 THEN k + 7919 ELSE k END"
_third = "CASE WHEN k % 4 = 0 THEN k + 104729 ELSE k END"
_part = "k + 15485863"
KINDS = [
    ("customer", "c_custkey", "S1", "", "k", "k", core_name("k", LONG), address("k", WAYS)),
    ("customer", "c_custkey", "S2", "", "k", _own, other_name("x"), f"CASE WHEN x % 23 = 4 THEN '' WHEN x % 3 = 1 THEN {address('x', WAYS)} ELSE {address('x', WAYS_SHORT, 'x % 2 = 0')} END"),
    ("supplier", "s_suppkey", "S3", "s", "2 * k", _third, f"CASE WHEN x % 29 = 8 THEN '' ELSE {core_name('x', SHORT)} END", address("x", WAYS_SHORT)),
    ("part", "p_partkey", "S3", "p", "2 * k + 1", _part, f"p_name || ' ' || {core_name('x', SHORT)}", f"p_brand || ', ' || {address('x', WAYS)}"),
]
ENTITY_COLUMNS = ["entity_id", "source", "pos", "country", "business_name", "business_address"]


def columns(source: str, prefix: str, pos: str, name: str, where: str) -> list[str]:
    return [f"'{source}-{prefix}' || {text('k')} AS entity_id", f"'{source}' AS source", f"CAST({pos} AS BIGINT) AS pos", f"{country('x')} AS country", f"{name} AS business_name", f"{where} AS business_address"]


ENTITIES_SQL = (
    "ent AS ("
    + " UNION ALL ".join(f"SELECT {', '.join(columns(s, p, pos, name, where))} FROM (SELECT *, {x} AS x FROM (SELECT *, {key} AS k FROM {t}))" for t, key, s, p, pos, x, name, where in KINDS)
    + ")"
)


def scratch(s: SparkSession, name: str) -> str:
    """A new place in the folder that all executors share; only a local master may do without."""
    folder = s.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not s.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + os.path.join(tempfile.gettempdir(), "kinfold-queries")
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` as a Parquet table in a new place, read back: its plan ends there."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: The tables of the query that is being made, by the function they come from.
_tables: ContextVar[dict | None] = ContextVar("tables", default=None)


def query(f: Callable[..., DataFrame], needs: list[str] | None = None) -> Callable[..., DataFrame]:
    """f, in which each `once` table is made a single time. needs: the columns of records that
    it reads (all, if None): others are not made."""

    @wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        token = _tables.set({"needs": needs} if needs else {})
        try:
            return f(spark, sf_dir)
        finally:
            _tables.reset(token)

    return run


def once(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """f's table, stored where a query first needs it and read from there by the rest of it."""

    @wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = _tables.get()
        tables = {} if tables is None else tables
        if f.__name__ not in tables:
            tables[f.__name__] = stored(f(spark, sf_dir), f.__name__)
        return tables[f.__name__]

    return run


def spread(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Rows of a raw table, dealt to as many tasks as a shuffle has: texts are long work on few
    bytes, and a file of few bytes is one task."""
    return spark.read.parquet(path).select(*columns).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), columns[0])


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for table, key, source, prefix, pos, x, name, where in KINDS:
        rows = spread(spark, f"{sf_dir}/{table}.parquet", [key, *[c for c in ("p_name", "p_brand") if c[0] == key[0]]]).withColumn("k", F.col(key)).withColumn("x", F.expr(x))
        one = rows.selectExpr(*columns(source, prefix, pos, name, where))
        out = one if out is None else out.unionByName(one)
    return out


@once
def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    needs = (_tables.get() or {}).get("needs")
    out = normalized(entities(spark, sf_dir))
    return out.select(*needs) if needs else out


#: True pairs: a customer with itself in S2, and with the supplier of its number.
TRUTH_SQL = """
truth AS (
  SELECT 'S1-' || c_custkey AS s1_id, 'S2-' || c_custkey AS cand_id FROM customer WHERE c_custkey % 5 <> 0
  UNION SELECT 'S1-' || c_custkey, 'S3-s' || s_suppkey FROM customer JOIN supplier ON c_custkey = s_suppkey WHERE s_suppkey % 4 <> 0)
"""


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, s = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("customer", "supplier"))
    first = F.concat(F.lit("S1-"), "c_custkey").alias("s1_id")
    second = c.where("c_custkey % 5 <> 0").select(first, F.concat(F.lit("S2-"), "c_custkey").alias("cand_id"))
    third = c.join(s.where("s_suppkey % 4 <> 0"), c["c_custkey"] == s["s_suppkey"]).select(first, F.concat(F.lit("S3-s"), "s_suppkey").alias("cand_id"))
    return second.union(third).distinct()


__all__ = ["ENTITIES_SQL", "TRUTH_SQL", "entities", "records", "truth"]

import unicodedata

import pytest
from pyspark.sql import functions as F

from kinfold.functions import text
from kinfold.functions.metaphone import metaphone
from kinfold.operators.records import normalized


def values(spark, rows, *exprs):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + ", ".join(f"c{k} string" for k in range(len(rows[0]))))
    return [tuple(r)[1:] for r in df.select("i", *exprs).orderBy("i").collect()]


#: Two spellings of one name, a rule of normalization to each pair.
SPELLINGS = [
    ("Oakmere Tiles Private Limited", "Oakmere Tiles Pvt. Ltd."), ("Oakmere Tiles Public Limited", "Oakmere Tiles Ltd"), ("Fenwick Limited Liability Company", "Fenwick L.L.C."), ("Fenwick Limited Liability Partnership", "Fenwick L L P"),
    ("Lune Société à responsabilité limitée", "Lune S.A.R.L."), ("Lune Société par actions simplifiée unipersonnelle", "LUNE SASU"), ("Lune Société par actions simplifiée", "Lune S.A.S"), ("Orme Entreprise unipersonnelle à responsabilité limitée", "Orme EURL"),
    ("Orme Société civile immobilière", "Orme S.C.I."), ("Orme Société Anonyme", "orme sa"), ("Dubreuil et Fils", "Dubreuil fils"), ("Dubreuil et Frères", "DUBREUIL FRERES"), ("Tarn Corporation", "Tarn Corp."), ("Tarn Incorporated", "Tarn INC"),
    ("Tarn Company", "Tarn Co."), ("Tarn Compagnie", "Tarn Cie."), ("Pike & Marsh Ltd", "Pike and Marsh Limited"), ("Holm Dairy", "Quill Partners dba Holm Dairy"), ("Holm Dairy", "Quill Partners trading as: Holm Dairy"), ("Holm Dairy", "Quill formerly known as Holm Dairy"),
    ("Holm Dairy", "Holm Dairy (ID: 4411)"), ("Holm Dairy", "Holm Dairy [#12]"), ("Rao Exports", "M/s Rao Exports"), ("Rao Exports", "Shri. Rao Exports"), ("Bäckerei Größe", "BACKEREI GROßE"), ("Holm-Dairy", "holm   dairy"),
]


@pytest.mark.parametrize("pair", SPELLINGS)
def test_spellings_of_a_name_meet(spark, pair):
    got = values(spark, [pair], text.normalize_name(F.col("c0")), text.normalize_name(F.col("c1")))
    assert got[0][0] == got[0][1] != ""


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        (None, ""), ("   ", ""), ("A aka B dba C", "b dba c"), ("Alpha aka Beta dba Gamma", "beta dba gamma"), ("professional limited liability company", "professional llc"), ("p.l.l.c. x", "pllc x"),
        ("Joe's a team", "joe sa team"), ("A & B Co.", "a and b co"), ('"Quoted Name', "quoted name"), ("NA", "na"), ("कि खग", "क खग"), ("²x ①", "2x 1"),
    ],
)
def test_names(spark, raw, want):
    assert values(spark, [(raw,)], text.normalize_name(F.col("c0"))) == [(want,)]


def test_accents_are_nfkd(spark):
    raw = ["é", "ﬁ", "ＡＢ", "Ångström", "½", "日本", "ASCII", "ß"]
    want = ["".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c)) for x in raw]
    assert [r[0] for r in values(spark, [(x,) for x in raw], text.strip_accents(F.col("c0")))] == want


ADDRESSES = [
    ("2621 Cotten Road, Tyler, TX", "US", "2621 cotten road tyler tx", "tyler", "", ""),
    ("IA, Iowa City, 1064 Newton Rd, Unit 11", "US", "ia iowa city 1064 newton road unit 11", "iowa city", "", ""),
    ("20 Rue Parmentier, Dunkerque, Hauts-de-France", "France", "20 rue parmentier dunkerque hauts de france", "dunkerque", "", ""),
    ("1 rue Jodelle, 44600 ST NAZAIRE, Saint-Nazaire, Pays de la Loire", "France", "1 rue jodelle 44600 street nazaire saint nazaire pays de la loire", "saint-nazaire", "44600", ""),
    ("26, Ram Nagar, Behind M.C Quarters Near Jagadhri Gate, Ambala City, Haryana", "India", "26 ram nagar behind m c quarters near jagadhri gate ambala city haryana", "ambala city", "", "behind m.c quarters near jagadhri gate"),
    ("14028 Irving Hill Drive, Boise, ID 83702", "US", "14028 irving hill drive boise id 83702", "boise", "83702", ""),
    ("MG Road, Pune 411001", "India", "mg road pune 411001", "", "411001", ""),
    ("12 Hill St, Springfield 70123, Ghana", "Ghana", "12 hill street springfield 70123 ghana", "springfield 70123", "70123", ""),
    ("Aix, Provence-Alpes-Côte d'Azur", "France", "aix provence alpes cote d azur", "aix", "", ""),
    ("", "US", "", "", "", ""),
]


def test_addresses(spark):
    rows = [(f"S1-{i}", "n", a, c, "S1", i) for i, (a, c, *_) in enumerate(ADDRESSES)]
    df = spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string, source string, pos long")
    got = {r.pos: (r.address_norm, r.city_norm, r.pincode, r.landmark) for r in normalized(df).collect()}
    for i, (_, _, norm, city, pin, mark) in enumerate(ADDRESSES):
        assert got[i][0] == norm and got[i][2:] == (pin, mark)
        assert got[i][1] == city or not city


def test_core_loses_what_follows_a_landmark(spark):
    rows = [("S1-1", "n", "5 Oak Road, Near Old Mill, Salem", "US", "S1", 1)]
    df = spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string, source string, pos long")
    assert normalized(df).first()["address_core"] == "5 oak road"
    assert normalized(df, clause_aware=True).first()["address_core"] == "5 oak road salem"


def test_abbreviations_whatever_the_context(spark):
    got = values(spark, [("St Rd # 5 / All Opp",)], text.normalize_address(F.col("c0")))
    assert got == [("street road number 5 allee opposite",)]


#: By the published rules: silent beginnings, C before E, I, Y, GH, PH, TH, SH, TIO, DGE, doubled letters, MB.
CODES = [
    ("knee", "N"), ("wrap", "RP"), ("gnome", "NM"), ("xenon", "SNN"), ("whale", "WL"), ("physics", "FSKS"), ("school", "SKL"), ("cell", "SL"), ("cat", "KT"), ("church", "XRX"), ("special", "SPXL"), ("bridge", "BRJ"),
    ("night", "NT"), ("though", "0"), ("thing", "0NK"), ("shine", "XN"), ("nation", "NXN"), ("lamb", "LM"), ("lumber", "LMBR"), ("queen", "KN"), ("fox", "FKS"), ("very", "FR"), ("yes", "YS"), ("zoo", "S"), ("back", "BK"), ("science", "SNS"), ("ahead", "AHT"), ("sign", "SN"), ("", ""), ("42", ""),
]


@pytest.mark.parametrize(("word", "code"), CODES)
def test_sound_keys(word, code):
    assert metaphone(word) == code

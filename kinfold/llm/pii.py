r"""Personal data: base patterns, and terms that give a protected entity away.

All of it is DataFrame expressions. Base spans come from four patterns (email, ip, card,
phone). Each matched value is a protected entity; the words around its occurrences are its
terms. Over the whole corpus

    PMI(term; entity) = log( p(term in a context | entity) / p(term in a context) )
    IC(entity)        = -log p(entity in a context)

and a term whose PMI reaches THRESHOLD times IC tells the entity from the term alone: all its
occurrences, in every document that holds the entity, are spans of kind `term`. Contexts count
once however often they are copied; PRIOR contexts more, in which terms come as in the whole
corpus, make what few contexts show count less.

The patterns below match what the plain ones match (`[A-Za-z0-9._%+-]+@...` and so on), but
start only where a match can start and hold no repeated group, so that long runs cost no
stack and no quadratic time; tests hold them against the plain ones.

Defined results: a null text is empty and has no spans; repeated rows each get their spans;
a null doc_id is an id like others; other columns pass by. Positions are code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinfold.llm.common import small, steps, table, text_of, written

KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++\.[A-Za-z0-9-][A-Za-z0-9.-]*?(?=\.?+(?![A-Za-z0-9.-])|\.\.)",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Characters of context on either side of an entity.
WINDOW = 48
#: Spans on either side that a window can meet: of each kind one in five characters, and one over.
NEIGHBOURS = len(KINDS) * (WINDOW // 5 + 2)
#: Characters of the blocks that contexts are taken from.
BLOCK = 1024
#: Words of a context, for p(term in a context).
WINDOW_WORDS = 16
PRIOR = 1.0
THRESHOLD = 0.7
#: Two letters or digits at least.
TERM = r"[\p{L}\p{N}][\p{L}\p{M}\p{N}]+"
SPAN = "struct<start:int,kind_no:int,end:int,kind:string,value:string>"


def located(text: Column, pattern: str) -> Column:
    """array<struct<start, end, value>> of a pattern's matches, from the lengths of what lies between."""
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def step(acc, x):
        start = acc["at"] + F.length(x["between"])
        end = start + F.length(x["value"])
        return F.struct(end.cast("int").alias("at"), F.concat(acc["out"], F.array(F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"), x["value"].alias("value")))).alias("out"))

    both = F.zip_with(F.slice(between, 1, F.size(found)), found, lambda b, v: F.struct(b.alias("between"), v.alias("value")))
    return F.when(F.size(found) > 0, F.aggregate(both, F.struct(F.lit(0).alias("at"), empty.alias("out")), step)["out"]).otherwise(empty)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    d = F.reverse(digits(value))
    at = lambda i: F.substring(d, i, F.lit(1)).cast("int")
    doubled = lambda x: F.when(x > 4, 2 * x - 9).otherwise(2 * x)
    total = F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), lambda acc, i: acc + F.when(i % 2 == 1, at(i)).otherwise(doubled(at(i))))
    return total % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        plain = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(plain, lambda p: (F.length(p) <= 3) & (p.try_cast("int") <= 255))
    if kind == "card":
        return luhn(value)
    if kind == "phone":
        return F.length(digits(value)).between(9, 15)
    return F.lit(True)


#: A text without these has no match of the kind: a cheap test before the pattern.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}


def kind_spans(text: Column, kind: str) -> Column:
    good = F.filter(located(text, PATTERNS[kind]), lambda x: valid(kind, x["value"]))
    found = F.transform(good, lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind_no"), x["end"].alias("end"), F.lit(kind).alias("kind"), x["value"].alias("value")))
    may = F.instr(text, F.lit(NEEDS[kind])) > 0 if NEEDS[kind] else text.rlike(PATTERNS[kind])
    return F.when(may, found).otherwise(F.array().cast(f"array<{SPAN}>"))


def base_spans(text: Column) -> Column:
    """All base spans of a text, by start, then kind as listed."""
    return F.array_sort(F.concat(*(kind_spans(text, kind) for kind in KINDS)))


def entity(span: Column) -> Column:
    return F.concat_ws(":", span["kind"], F.when(span["kind"].isin("card", "phone"), digits(span["value"])).otherwise(F.lower(span["value"])))


def let(value: Column, use) -> Column:
    """use(value) with value computed once: inside a lambda an expression is not shared."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def part(blocks: Column, at: Column, size: Column) -> Column:
    """`size` characters (BLOCK at most) of a text from `at` on, given its blocks: the cost does
    not depend on the text's length."""
    k = F.floor(at / BLOCK).cast("int")
    two = F.concat(F.coalesce(F.get(blocks, k), F.lit("")), F.coalesce(F.get(blocks, k + 1), F.lit("")))
    return F.substring(two, (at - k * BLOCK + 1).cast("int"), size)


def beside(blocks: Column, n: Column, span: Column, spans: Column) -> Column:
    """array<struct<entity, context, term>> of the words around one span of a text of n
    characters; words that touch one of `spans` are none."""
    begin = F.greatest(span["start"] - WINDOW, F.lit(0))
    cut = F.struct(begin.alias("begin"), part(blocks, begin, span["start"] - begin).alias("left"), part(blocks, span["end"], F.lit(WINDOW)).alias("right"))

    def inside(w):
        # a word cut off at the window's edge is no word
        head = F.when(w["begin"] > 0, F.length(F.regexp_extract(w["left"], r"^\S+", 0))).otherwise(F.lit(0))
        tail = F.when(span["end"] + WINDOW < n, F.regexp_replace(w["right"], r"\S+$", "")).otherwise(w["right"])
        return let(
            F.struct(head.alias("head"), tail.alias("tail")),
            lambda h: let(
                F.struct(
                    F.xxhash64(w["left"], h["tail"]).alias("context"),
                    entity(span).alias("entity"),
                    F.array(F.struct(F.substring(w["left"], h["head"] + 1, F.lit(WINDOW)).alias("text"), (w["begin"] + h["head"]).alias("at")), F.struct(h["tail"].alias("text"), span["end"].alias("at"))).alias("sides"),
                ),
                lambda c: F.flatten(F.transform(c["sides"], lambda side: words(c, side))),
            ),
        )

    def words(c, side):
        free = F.filter(located(side["text"], TERM), lambda x: ~F.exists(spans, lambda s: (x["start"] + side["at"] < s["end"]) & (s["start"] < x["end"] + side["at"])))
        return F.transform(free, lambda x: F.struct(c["entity"].alias("entity"), c["context"].alias("context"), F.lower(x["value"]).alias("term")))

    return let(cut, inside)


def around(text: Column, spans: Column) -> Column:
    """The words around all spans of a text.

    A window meets only its span's neighbours: spans of a kind don't overlap and have five
    characters or more, so at most NEIGHBOURS before and after are near.
    """
    n = F.length(text)
    blocks = F.transform(F.sequence(F.lit(0), F.floor(n / BLOCK).cast("int")), lambda i: F.substring(text, i * BLOCK + 1, F.lit(BLOCK)))
    near = lambda i: F.slice(spans, F.greatest(i - NEIGHBOURS + 1, F.lit(1)), F.lit(2 * NEIGHBOURS + 1))
    once = F.struct(blocks.alias("blocks"), n.alias("n"))
    return let(once, lambda t: F.flatten(F.transform(spans, lambda s, i: let(near(i), lambda some: beside(t["blocks"], t["n"], s, some)))))


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, code (of the text), spans, near: one scan of the texts, written without them."""
    text = F.col("text")
    base = text_of(docs.select("doc_id", "text")).withColumn("spans", base_spans(text)).withColumn("code", F.xxhash64("text"))
    none = F.array().cast("array<struct<entity:string,context:bigint,term:string>>")
    near = F.when(F.size("spans") > 0, around(text, F.col("spans"))).otherwise(none)
    n = F.when(F.length(F.trim(text)) > 0, F.size(F.split(F.trim(text), r"[\x20\x09-\x0D]+"))).otherwise(F.lit(0))
    return written(base.select("doc_id", "code", "spans", near.alias("near"), n.cast("long").alias("n")), "pii-scan")


def disclosing(docs: DataFrame, scan: DataFrame, threshold: float = THRESHOLD, prior: float = PRIOR) -> DataFrame:
    """entity, term, ratio: pairs whose term discloses the entity."""
    seen = scan.select(F.explode("near").alias("x")).select("x.entity", "x.context", "x.term").distinct()
    pairs = seen.groupBy("entity", "term").agg(F.count("*").alias("together"))
    entities = seen.select("entity", "context").distinct().groupBy("entity").agg(F.count("*").alias("contexts"))
    pairs = written(pairs.join(entities, "entity"), "pii-pairs")
    terms = small(pairs.select("term").distinct())
    words = text_of(docs.select("text")).select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(TERM), F.lit(0))).alias("term"))
    # counted before the join: its rows then number the terms, not their occurrences
    counts = words.groupBy("term").agg(F.count("*").alias("n_term")).join(terms, "term")
    total = scan.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"] or 1
    windows = max(total / WINDOW_WORDS, 1.0)
    p_term = F.least(F.lit(1.0), F.coalesce(F.col("n_term"), F.col("together")) / windows)
    pmi = F.log((F.col("together") + prior * p_term) / (F.col("contexts") + prior) / p_term)
    ic = -F.log(F.least(F.lit(0.5), F.col("contexts") / F.lit(windows)))
    return pairs.join(counts, "term", "left").withColumn("ratio", pmi / ic).where(F.col("ratio") >= threshold).select("entity", "term", "ratio")


def term_spans(docs: DataFrame, scan: DataFrame, threshold: float = THRESHOLD, prior: float = PRIOR) -> DataFrame:
    """doc_id, code, terms: every occurrence of the terms that disclose an entity the document holds."""
    found = small(written(disclosing(docs, scan, threshold, prior), "pii-terms"), 200_000).select("entity", "term")
    held = scan.where(F.size("spans") > 0).select("doc_id", "code", F.explode(F.transform("spans", entity)).alias("entity")).distinct()
    wanted = written(held.join(found, "entity").select(F.col("doc_id").alias("w_id"), F.col("code").alias("w_code"), F.col("term").alias("w_term")).distinct(), "pii-wanted")
    of = small(wanted.select("w_id", "w_code").distinct(), 200_000)
    texts = text_of(docs.select("doc_id", "text")).withColumn("code", F.xxhash64("text"))
    texts = texts.join(of, texts["doc_id"].eqNullSafe(of["w_id"]) & (texts["code"] == of["w_code"]), "left_semi").dropDuplicates(["doc_id", "code"])
    # a word's place: the lengths of all words and gaps before it
    gaps, all_ = F.split("text", TERM, -1), F.regexp_extract_all("text", F.lit(TERM), F.lit(0))
    words = texts.select("doc_id", "code", F.posexplode(F.arrays_zip(F.slice(gaps, 1, F.size(all_)).alias("gap"), all_.alias("word"))).alias("i", "x"))
    words = words.select("doc_id", "code", "i", F.length("x.gap").alias("gap"), F.length("x.word").alias("size"), F.lower("x.word").alias("term"))
    end = F.sum(F.col("gap") + F.col("size")).over(Window.partitionBy("doc_id", "code").orderBy("i").rowsBetween(Window.unboundedPreceding, 0))
    words = words.withColumn("end", end.cast("int"))
    pairs = small(wanted, 200_000)
    hits = words.join(pairs, words["doc_id"].eqNullSafe(pairs["w_id"]) & (words["code"] == pairs["w_code"]) & (words["term"] == pairs["w_term"]), "left_semi")
    hits = hits.select("doc_id", "code", (F.col("end") - F.col("size")).alias("start"), "end", "term")
    # a term that touches a base span is none: spans before it may reach into it, the next may begin in it
    of_spans = scan.join(of, scan["doc_id"].eqNullSafe(of["w_id"]) & (scan["code"] == of["w_code"]), "left_semi").select("doc_id", "code", F.explode("spans").alias("s"))
    events = hits.unionByName(of_spans.select("doc_id", "code", "s.start", "s.end", F.lit(None).cast("string").alias("term")))
    base = F.col("term").isNull()
    by = Window.partitionBy("doc_id", "code").orderBy("start", base.desc())
    reach = F.max(F.when(base, F.col("end"))).over(by.rowsBetween(Window.unboundedPreceding, -1))
    following = F.min(F.when(base, F.col("start"))).over(by.rowsBetween(1, Window.unboundedFollowing))
    free = events.withColumn("reach", reach).withColumn("following", following).where(~base & (F.coalesce("reach", F.lit(0)) <= F.col("start")) & (F.coalesce("following", F.col("end")) >= F.col("end")))
    span = F.struct("start", F.lit(len(KINDS)).alias("kind_no"), "end", F.lit("term").alias("kind"), F.col("term").alias("value"))
    return free.groupBy("doc_id", "code").agg(F.sort_array(F.collect_list(span)).alias("terms"))


def with_terms(df: DataFrame, terms: DataFrame) -> DataFrame:
    """`df` (doc_id, code, spans, ...) with the added spans among its own."""
    t = small(written(terms, "pii-spans"), 200_000).withColumnsRenamed({"doc_id": "t_id", "code": "t_code"})
    joined = df.join(t, df["doc_id"].eqNullSafe(t["t_id"]) & (df["code"] == t["t_code"]), "left").drop("t_id", "t_code")
    return joined.withColumn("all_spans", F.array_sort(F.concat("spans", F.coalesce("terms", F.array().cast(f"array<{SPAN}>"))))).drop("terms")


def listed(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(docs: DataFrame, threshold: float = THRESHOLD, prior: float = PRIOR) -> DataFrame:
    """doc_id, spans (base), all_spans for every row of docs."""
    with steps(docs.sparkSession, "pii-scan", "pii-spans"):
        scan = scanned(docs)
        out = with_terms(scan.select("doc_id", "code", "spans"), term_spans(docs, scan, threshold, prior))
    return out.select("doc_id", "spans", "all_spans")


def sanitize(docs: DataFrame, threshold: float = THRESHOLD, prior: float = PRIOR) -> DataFrame:
    """docs with base spans and disclosing terms generalised to their kinds in brackets.

    A null text stays null; texts without spans stay as they are, and all other columns.
    """
    own = {c: f"__doc_{c}" for c in docs.columns if c.lower() in ("code", "spans", "all_spans", "terms", "t_id", "t_code")}
    df = docs.withColumnsRenamed(own)
    df = df.withColumn("code", F.xxhash64(F.coalesce("text", F.lit("")))).withColumn("spans", base_spans(F.coalesce("text", F.lit(""))))
    with steps(docs.sparkSession, "pii-spans"):
        df = with_terms(df, term_spans(docs, scanned(docs), threshold, prior))
    text = F.col("text")

    def step(acc, s):
        cut = F.concat(acc["out"], F.array(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(s["start"] >= acc["at"], cut).otherwise(acc["out"]).alias("out"))

    made = F.aggregate("all_spans", F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")), step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.length(text))))
    out = F.when(F.size("all_spans") > 0, made).otherwise(text)
    return df.withColumn("text", out).drop("code", "spans", "all_spans").withColumnsRenamed({v: k for k, v in own.items()}).select(*docs.columns)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == F.lit(k))).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *(count(k) for k in KINDS), F.sha2(listed("spans").cast("binary"), 256).alias("base_sha256"), listed("all_spans").alias("spans"))

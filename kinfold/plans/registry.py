"""The reference queries over the test tables, and their SQL."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from kinfold.functions import fixed, text
from kinfold.operators import blocking, metrics, model, pairs, rules, validate
from kinfold.plans import oracle
from kinfold.plans.adapter import TRUTH_SQL, entities, once, query, records, scratch, stored, truth
from kinfold.sources import tsv
from kinfold.sources.tsv import wide_lists
from kinfold.streaming.match import stream_matches

PATTERNS = {"with_digits": "[0-9]", "with_symbols": "[#*$%&|]", "with_mail": "@"}
SIX = ("f05", "precision", "recall", "recall_ceiling", "avg_candidates", "reduction_ratio", "ratio")


def six(df):
    """Ratios to six digits: sums come in any order."""
    return df.select(*[F.round(c, 6).alias(c) if c in SIX else c for c in df.columns])


def normalized_names(s, d):
    return records(s, d).select("entity_id", "name_norm")


def normalized_addresses(s, d):
    return records(s, d).select("entity_id", "address_norm", "address_core", "landmark", "city_norm", "pincode")


def accents(s, d):
    docs = s.read.parquet(f"{d}/documents.parquet")
    return docs.select("doc_id", F.md5(text.strip_accents(F.col("text")).cast("binary")).alias("plain"))


def distinctive_tokens(s, d):
    r = records(s, d)
    join = lambda c, stop: F.array_join(text.distinctive(text.tokens(F.col(c)), stop), " ")
    return r.select("entity_id", join("name_norm", fixed.NAME_STOPWORDS).alias("name_words"), join("address_core", fixed.ADDRESS_STOPWORDS).alias("address_words"))


def short(df):
    return df.select("s1_id", "cand_id", "source", "score", "hits", "block_reason")


def block_names(s, d):
    return short(blocking.block_names(records(s, d), with_sound=False))


def block_names_sound(s, d):
    return short(blocking.block_names(records(s, d)))


def block_addresses(s, d):
    return short(blocking.block_addresses(records(s, d)))


def bucket_drop(s, d):
    return short(blocking.block_addresses(records(s, d), cap=5, bucket=6))


def bucket_truncate(s, d):
    """The hot names of parts as postings, cut at the first 20 of each bucket."""
    p = s.read.parquet(f"{d}/part.parquet").select(F.lit("x").alias("country"), F.lit("name").alias("pass"), F.col("p_name").alias("key"), F.lit("S2").alias("source"), F.col("p_partkey").alias("pos"), F.lit(0).alias("event"))
    return blocking.truncated(p, 20).select("key", "pos", "rank")


def capped_lookups(s, d, names=block_names):
    return blocking.capped_lookups(records(s, d), bucket=5, with_sound=with_sound(names))


def with_sound(names):
    return names is block_names_sound


def name_pairs(s, d, names):
    return pairs.of_members(*pairs.name_classes(records(s, d), with_sound(names)))


def name_features(s, d, names=block_names):
    return name_pairs(s, d, names).select("s1_id", "cand_id", "levenshtein_sim", "token_jaccard", "char_ngram_cos", "exact_match")


def name_ratios(s, d, names=block_names):
    return name_pairs(s, d, names).select("s1_id", "cand_id", "token_sort_ratio", "token_set_ratio")


def address_features(s, d):
    return pairs.with_address_features(block_addresses(s, d).select("s1_id", "cand_id"), records(s, d))


def lists(s, d, names):
    """Both tracks, with a row for each entity."""
    return blocking.name_lists(records(s, d), with_sound=with_sound(names)), blocking.address_lists(records(s, d))


def union_tracks(s, d, names=block_names):
    return pairs.tracks_of_lists(*lists(s, d, names))


def merged_matrix(s, d, names=block_names):
    return pairs.merged(name_pairs(s, d, names), address_features(s, d), truth(s, d))


def labels(s, d, names=block_names):
    return pairs.tracks_of_lists(*lists(s, d, names), truth(s, d))


def provenance_counts(s, d, names=block_names):
    return six(metrics.provenance_counts(labels(s, d, names)))


@once
def rule_match(s, d):
    return rules.rule_lists(records(s, d))


def anti_fallback(s, d):
    return rules.name_hits(*rules.sides(records(s, d))).select("s1_id", "cand_id", "match")


def truth_lists(s, d):
    first = entities(s, d).where("source = 'S1'")
    return wide_lists(first, truth(s, d), "matched_entity_ids").select("source1_entity_id", "matched_entity_ids")


def scored(s, d, names=block_names):
    df = pairs.of_members(*pairs.name_classes(records(s, d), with_sound(names)), truth(s, d))
    return df.select("s1_id", "cand_id", F.col("token_jaccard").alias("probability"), "label")


def macro_f05(s, d, names=block_names):
    return six(metrics.macro_f05(scored(s, d, names), truth(s, d), 0.5))


def threshold_sweep(s, d, names=block_names):
    return six(metrics.threshold_sweep(scored(s, d, names), truth(s, d)))


def best_threshold(s, d, names=block_names):
    return metrics.best_threshold(threshold_sweep(s, d, names))


def name_report(s, d, names=block_names):
    return six(metrics.blocking_report(once(names)(s, d), truth(s, d), records(s, d), per_all=False))


def address_report(s, d):
    return six(metrics.blocking_report(once(block_addresses)(s, d), truth(s, d), records(s, d), per_all=True, by_country=True))


def combined_recall(s, d, names=block_names):
    return metrics.captured(metrics.true_in_lists(*lists(s, d, names), truth(s, d)))


def missed_pairs(s, d, names=block_names):
    return metrics.true_in_lists(*lists(s, d, names), truth(s, d)).where("NOT n AND NOT a").select("s1_id", "cand_id")


def country_counts(s, d):
    return entities(s, d).groupBy("source", "country").agg(F.count("*").alias("n"))


def length_stats(s, d):
    df = metrics.length_stats(entities(s, d), "business_address", ["source", "country"])
    return df.select("source", "country", "n", *[F.round(c, 6).alias(c) for c in df.columns if c not in ("source", "country", "n")])


def missing_counts(s, d):
    return metrics.missing_counts(entities(s, d), ["business_name", "business_address", "country"])


def pattern_counts(s, d):
    return metrics.pattern_counts(s.read.parquet(f"{d}/documents.parquet"), "text", PATTERNS, ["lang"])


def common_words(s, d):
    return metrics.common_words(entities(s, d), "business_address")


@once
def planted(s, d):
    """The rule matcher's lists with a fault of each kind, by the entity's number modulo 50: rows
    that are gone (2) or repeated (1), ids that are repeated (4), a first-source id (3), of no
    known kind (5), or of no record (0)."""
    lists = rule_match(s, d).join(entities(s, d).where("source = 'S1'").select(F.col("entity_id").alias("source1_entity_id"), (F.col("pos") % 50).alias("k")), "source1_entity_id").where("k <> 2")
    m = F.col("matched_entity_ids")
    more = F.when(m == "", m).when(F.col("k") == 4, F.concat(m, F.lit(","), m)).when(F.col("k") == 3, F.concat(m, F.lit(",S1-1"))).when(F.col("k") == 5, F.concat(m, F.lit(",Q7"))).when(F.col("k") == 0, F.concat(m, F.lit(",S2-none"))).otherwise(m)
    lists = lists.withColumn("matched_entity_ids", more)
    return lists.union(lists.where("k = 1"))


def violations(s, d):
    """Faulty lists against a universe without the entities whose number ends in 7, and known
    ids without those that end in 3."""
    e = entities(s, d)
    need = e.where("source = 'S1' AND pos % 10 <> 7").select(F.col("entity_id").alias("s1_id"))
    known = e.where("source <> 'S1' AND pos % 10 <> 3").select(F.col("entity_id").alias("cand_id"))
    return validate.list_violations(planted(s, d), "matched_entity_ids", need, known).select("rule", "id")


def fifteen_points(s, d):
    """The faulty lists as matches, the sound ones as candidates, under one wrong header."""
    e, headers = entities(s, d), {"matches": "source1_entity_id\tmatched_entity_ids", "candidates": "source1_entity_id\tcandidates"}
    first, rest = e.where("source = 'S1'").select(F.col("entity_id").alias("s1_id")), e.where("source <> 'S1'").select(F.col("entity_id").alias("cand_id"))
    return validate.fifteen_points(planted(s, d), rule_match(s, d), first, rest, headers).select("rule", "passed")


def entity_split(s, d, names=block_names):
    return model.split_entities(union_tracks(s, d, names)).groupBy("s1_id", "validation").agg(F.count("*").alias("rows"))


def runner_ratios(s, d, names=block_names):
    return six(metrics.runner_ratios(names(s, d), block_addresses(s, d), records(s, d)))


def true_pairs_shown(s, d):
    return metrics.side_by_side(truth(s, d), entities(s, d))


def scanned_records(s, d):
    """The entities as three tab-separated files, scanned again."""
    e, paths = entities(s, d), {source: scratch(s, "records") for source in ("S1", "S2", "S3")}
    for source, path in paths.items():
        tsv.write_tsv(e.where(F.col("source") == source).select(*tsv.ENTITY), path)
    return tsv.read_sources(s, paths).select("source", *tsv.ENTITY)


def scanned_truth(s, d):
    """Ground truth as a file, read as pairs; and the first-source ids without any."""
    path = scratch(s, "truth")
    tsv.write_tsv(truth_lists(s, d), path)
    found, universe = tsv.read_ground_truth(s, path)
    return universe.join(found, "s1_id", "left").select("s1_id", "cand_id")


def scanned_candidates(s, d):
    """Candidates as a wide and as a long file, read by the form that their header tells."""
    names, wide, long = once(block_names)(s, d), scratch(s, "wide"), scratch(s, "long")
    first = entities(s, d).where("source = 'S1'")
    tsv.write_tsv(wide_lists(first, names, "candidate_entity_ids").drop("pos"), wide)
    tsv.write_tsv(names.select(F.col("s1_id").alias("source1_entity_id"), F.col("cand_id").alias("candidate_entity_id"), "source", "block_reason"), long)
    read = lambda path, form: tsv.candidate_pairs(tsv.read_tsv(s, path)).withColumn("form", F.lit(form))
    return read(wide, "wide").union(read(long, "long"))


def submission_rows(s, d):
    """The lines of both result files, in the files' order."""
    r, m, c = records(s, d), scratch(s, "matches") + ".tsv", scratch(s, "candidates") + ".tsv"
    found = rules.rule_pairs(r)
    tsv.write_submission(r.where("source = 'S1'").select("entity_id", "pos"), found.where("match"), found, m, c)
    lines = lambda path, name: tsv.in_file_order(s.read.text(path)).select(F.lit(name).alias("file"), "row", F.col("value").alias("line"))
    return lines(m, "matches").union(lines(c, "candidates"))


def numeric_features(s, d):
    """The canonical features of a table that has two of them, one partly no number."""
    lev = F.col("levenshtein_sim")
    df = name_features(s, d).select("token_jaccard", F.when(lev > 0.5, "odd").otherwise(lev.cast("string")).alias("levenshtein_sim"), "cand_id", "s1_id")
    return model.numeric(df).select("s1_id", "cand_id", *pairs.FEATURES)


def streamed_matches(s, d):
    """The rule matcher's matches, the second and third source arriving as a stream of files."""
    e, r, source, out = entities(s, d), records(s, d), scratch(s, "arriving"), scratch(s, "matched")
    e.where("source <> 'S1'").write.parquet(source)
    arriving = s.readStream.schema(e.schema).parquet(source)
    query = stream_matches(r, arriving).writeStream.format("parquet").option("checkpointLocation", scratch(s, "stream")).trigger(availableNow=True).start(out)
    query.awaitTermination()
    return s.read.schema("s1_id string, cand_id string").parquet(out)


def boosted_scores(s, d):
    # the trees read the matrix many times
    m = stored(model.split_entities(merged_matrix(s, d, block_names_sound)), "matrix")
    return model.score(model.train(m), m)


QUERIES = {f.__name__: f for f in (
    rule_match, normalized_names, normalized_addresses, accents, distinctive_tokens, block_names, block_names_sound, block_addresses, bucket_drop, bucket_truncate, capped_lookups,
    name_features, name_ratios, address_features, union_tracks, merged_matrix, labels, provenance_counts, anti_fallback, truth_lists, macro_f05, threshold_sweep, best_threshold,
    name_report, address_report, combined_recall, missed_pairs, country_counts, length_stats, missing_counts, pattern_counts, common_words, runner_ratios, true_pairs_shown, scanned_records, scanned_truth, scanned_candidates, submission_rows, numeric_features, streamed_matches, violations, fifteen_points, entity_split, boosted_scores,
)}

#: SQL has no sound keys: what it shows without them is made with all passes under these names.
WITH_SOUND = (capped_lookups, name_features, name_ratios, merged_matrix, entity_split, runner_ratios, union_tracks, labels, provenance_counts, macro_f05, threshold_sweep, best_threshold, name_report, combined_recall)
QUERIES |= {f"{f.__name__}_sound": partial(f, names=block_names_sound) for f in WITH_SOUND}
#: Queries that read no more of the records than their names; the rule matcher reads addresses too.
OF_NAMES = (block_names, capped_lookups, name_features, name_ratios, macro_f05, threshold_sweep, best_threshold, name_report, scanned_candidates, numeric_features)
OF_RULES = (rule_match, anti_fallback, violations, fifteen_points, submission_rows, streamed_matches)
NAMED = ["entity_id", "source", "pos", "country", "name_norm"]
#: And those that read both tracks' candidates, but no features.
OF_TRACKS = (block_addresses, bucket_drop, address_report, union_tracks, labels, provenance_counts, combined_recall, missed_pairs, entity_split, runner_ratios)
NEEDS = {f"{f.__name__}{end}": NAMED for f in OF_NAMES for end in ("", "_sound")} | {f.__name__: [*NAMED, "address_norm"] for f in OF_RULES}
NEEDS |= {f"{f.__name__}{end}": [*NAMED, "address_norm", "address_core", "city_norm", "pincode"] for f in OF_TRACKS for end in ("", "_sound")}
QUERIES = {name: query(f, NEEDS.get(name)) for name, f in QUERIES.items()}

_flags = "SELECT coalesce(n.s1_id, a.s1_id) AS s1_id, coalesce(n.cand_id, a.cand_id) AS cand_id, CASE WHEN n.s1_id IS NULL THEN 0 ELSE 1 END AS from_name, CASE WHEN a.s1_id IS NULL THEN 0 ELSE 1 END AS from_address FROM names n FULL JOIN addresses a ON n.s1_id = a.s1_id AND n.cand_id = a.cand_id"
_labelled = f"SELECT u.*, CASE WHEN t.s1_id IS NULL THEN 0 ELSE 1 END AS label FROM ({_flags}) u LEFT JOIN truth t ON u.s1_id = t.s1_id AND u.cand_id = t.cand_id"
_sweep = oracle.sweep_sql(metrics.THRESHOLDS)
_lengths = ", ".join(f"round({f}({v}), 6)::DOUBLE AS {n}_{v}" for v in ("chars", "words") for n, f in (("mean", "avg"), ("min", "min"), ("median", "median"), ("max", "max")))
_address_words = "list_filter(regexp_split_to_array(business_address, '\\s+'), lambda t: t <> '')"

ORACLES = {
    "rule_match": f"WITH {oracle.RULE_LISTS_SQL} SELECT * FROM lists",
    "normalized_names": f"WITH {oracle.RECORDS_SQL} SELECT entity_id, name_norm FROM rec",
    "normalized_addresses": f"WITH {oracle.RECORDS_SQL} SELECT entity_id, address_norm, address_core, landmark, city_norm, pincode FROM rec",
    "accents": 'SELECT doc_id, md5(strip_accents("text")) AS plain FROM documents',
    "distinctive_tokens": f"WITH {oracle.RECORDS_SQL} SELECT entity_id, array_to_string({oracle.distinctive('name_norm', fixed.NAME_STOPWORDS)}, ' ') AS name_words, array_to_string({oracle.distinctive('address_core', fixed.ADDRESS_STOPWORDS)}, ' ') AS address_words FROM rec",
    "block_names": f"WITH {oracle.NAME_BLOCKS_SQL} SELECT * FROM names",
    "block_addresses": f"WITH {oracle.ADDRESS_BLOCKS_SQL} SELECT * FROM addresses",
    "bucket_drop": f"WITH {oracle.address_blocks_sql(5, 6)} SELECT * FROM addresses",
    "bucket_truncate": "SELECT key, pos, rank::INTEGER AS rank FROM (SELECT p_name AS key, p_partkey AS pos, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS rank FROM part) WHERE rank <= 20",
    "capped_lookups": f"WITH {oracle.NAME_BLOCKS_SQL} SELECT count(*) AS capped_lookups FROM ev JOIN (SELECT DISTINCT country, pass, key FROM po1 WHERE size > 5) USING (country, pass, key)",
    "name_features": oracle.NAME_FEATURES_SQL,
    "address_features": oracle.ADDRESS_FEATURES_SQL,
    "union_tracks": f"WITH {oracle.TRACKS_SQL} {_flags}",
    "labels": f"WITH {oracle.TRACKS_SQL} {_labelled}",
    "provenance_counts": f"WITH {oracle.TRACKS_SQL} SELECT count(*) AS pairs, count(*) FILTER (WHERE from_name = 1 AND from_address = 0) AS name_only, count(*) FILTER (WHERE from_name = 0 AND from_address = 1) AS address_only, count(*) FILTER (WHERE from_name = 1 AND from_address = 1) AS both, count(*) FILTER (WHERE label = 1) AS positives, count(*) FILTER (WHERE label = 0) AS negatives, round(count(*) FILTER (WHERE label = 0) / greatest(count(*) FILTER (WHERE label = 1), 1), 6) AS ratio FROM ({_labelled})",
    "anti_fallback": f"WITH {oracle.HITS_SQL} SELECT s1_id, cand_id, match FROM h2",
    "truth_lists": f"WITH {oracle.ENTITIES_SQL}, {TRUTH_SQL} SELECT entity_id AS source1_entity_id, coalesce(array_to_string(list_sort(list(cand_id) FILTER (WHERE cand_id IS NOT NULL)), ','), '') AS matched_entity_ids FROM ent LEFT JOIN truth ON s1_id = entity_id WHERE source = 'S1' GROUP BY 1",
    "macro_f05": f"SELECT * EXCLUDE (threshold) FROM ({oracle.sweep_sql([0.5])})",
    "threshold_sweep": _sweep,
    "best_threshold": f"SELECT * FROM ({_sweep}) ORDER BY f05 DESC, threshold LIMIT 1",
    "name_report": oracle.report_sql(oracle.NAME_BLOCKS_SQL, "names", False, False),
    "address_report": oracle.report_sql(oracle.ADDRESS_BLOCKS_SQL, "addresses", True, True),
    "combined_recall": f"WITH {oracle.TRACKS_SQL}, z AS (SELECT n.s1_id IS NOT NULL AS n, a.s1_id IS NOT NULL AS a FROM truth t LEFT JOIN names n ON t.s1_id = n.s1_id AND t.cand_id = n.cand_id LEFT JOIN addresses a ON t.s1_id = a.s1_id AND t.cand_id = a.cand_id) SELECT count(*) AS total, count(*) FILTER (WHERE n) AS by_name, count(*) FILTER (WHERE a) AS by_address, count(*) FILTER (WHERE n AND a) AS by_both, count(*) FILTER (WHERE n AND NOT a) AS name_only, count(*) FILTER (WHERE a AND NOT n) AS address_only, count(*) FILTER (WHERE NOT a AND NOT n) AS missed FROM z",
    "missed_pairs": f"WITH {oracle.TRACKS_SQL} SELECT t.s1_id, t.cand_id FROM truth t WHERE NOT EXISTS (SELECT 1 FROM names n WHERE n.s1_id = t.s1_id AND n.cand_id = t.cand_id) AND NOT EXISTS (SELECT 1 FROM addresses a WHERE a.s1_id = t.s1_id AND a.cand_id = t.cand_id)",
    "country_counts": f"WITH {oracle.ENTITIES_SQL} SELECT source, country, count(*) AS n FROM ent GROUP BY ALL",
    "length_stats": f"WITH {oracle.ENTITIES_SQL}, x AS (SELECT source, country, length(business_address) AS chars, len({_address_words}) AS words FROM ent) SELECT source, country, count(*) AS n, {_lengths} FROM x GROUP BY ALL",
    "missing_counts": f"WITH {oracle.ENTITIES_SQL} SELECT count(*) AS rows, count(*) FILTER (WHERE trim(business_name) = '') AS missing_business_name, count(*) FILTER (WHERE trim(business_address) = '') AS missing_business_address, count(*) FILTER (WHERE trim(country) = '') AS missing_country FROM ent",
    "pattern_counts": "SELECT lang, count(*) AS n, " + ", ".join(f"count(*) FILTER (WHERE regexp_matches(\"text\", '{p}')) AS {n}" for n, p in PATTERNS.items()) + " FROM documents GROUP BY 1",
    "common_words": f"WITH {oracle.ENTITIES_SQL}, w AS (SELECT unnest({_address_words.replace('business_address', 'lower(business_address)')}) AS word FROM ent) SELECT word, count(*) AS n FROM w GROUP BY 1 ORDER BY n DESC, word LIMIT 40",
    "runner_ratios": f"WITH {oracle.TRACKS_SQL}, c AS (SELECT count(*) FILTER (WHERE source = 'S1' AND country <> '') AS n1, count(*) FILTER (WHERE source = 'S1') AS a1, count(*) FILTER (WHERE source <> 'S1' AND country <> '') AS total_cands FROM rec), x AS (SELECT 'name' AS track, n1 AS total_s1, total_cands, (SELECT count(*) FROM names) AS total_pairs FROM c UNION ALL SELECT 'address', a1, total_cands, (SELECT count(*) FROM addresses) FROM c) SELECT *, round(total_pairs / greatest(total_s1, 1), 6) AS avg_candidates, round(1 - total_pairs / greatest(total_s1 * total_cands, 1), 6) AS reduction_ratio FROM x",
    "true_pairs_shown": f"WITH {oracle.ENTITIES_SQL}, {TRUTH_SQL} SELECT s1_id, a.country, CASE WHEN length(a.business_name) > 35 THEN left(a.business_name, 32) || '...' ELSE a.business_name END AS s1_name, cand_id, left(cand_id, 2) AS source, CASE WHEN length(b.business_name) > 40 THEN left(b.business_name, 40) || '...' ELSE coalesce(b.business_name, 'UNKNOWN') END AS cand_name FROM truth JOIN ent a ON a.entity_id = s1_id LEFT JOIN ent b ON b.entity_id = cand_id ORDER BY a.pos, cand_id LIMIT 25",
    "scanned_records": f"WITH {oracle.ENTITIES_SQL} SELECT source, entity_id, business_name, business_address, country FROM ent",
    "scanned_truth": f"WITH {oracle.ENTITIES_SQL}, {TRUTH_SQL} SELECT entity_id AS s1_id, cand_id FROM ent LEFT JOIN truth ON s1_id = entity_id WHERE source = 'S1'",
    "scanned_candidates": f"WITH {oracle.NAME_BLOCKS_SQL} SELECT s1_id, cand_id, form FROM names, (SELECT unnest(['wide', 'long']) AS form)",
    "submission_rows": f"WITH {oracle.RULE_LISTS_SQL}, o AS (SELECT row_number() OVER (ORDER BY pos) AS row, lists.* FROM lists JOIN ent ON entity_id = source1_entity_id), x AS (SELECT 'matches' AS file, row, source1_entity_id || chr(9) || matched_entity_ids AS line FROM o UNION ALL SELECT 'candidates', row, source1_entity_id || chr(9) || candidate_entity_ids FROM o UNION ALL SELECT f || 's', 0, 'source1_entity_id' || chr(9) || c FROM (SELECT unnest(['matche', 'candidate']) AS f, unnest(['matched_entity_ids', 'candidate_entity_ids']) AS c)) SELECT file, row::BIGINT AS row, line FROM x",
    "numeric_features": f"SELECT s1_id, cand_id, CASE WHEN levenshtein_sim > 0.5 THEN 0.0 ELSE levenshtein_sim END::DOUBLE AS levenshtein_sim, token_jaccard, {', '.join(f'0.0::DOUBLE AS {c}' for c in pairs.FEATURES if c not in ('levenshtein_sim', 'token_jaccard'))} FROM ({oracle.NAME_FEATURES_SQL})",
    "streamed_matches": f"WITH {oracle.HITS_SQL} SELECT s1_id, cand_id FROM hits WHERE match",
    "name_ratios": f"WITH {oracle.RATIOS_SQL} SELECT s1_id, cand_id, token_sort_ratio, token_set_ratio FROM ratios",
    "merged_matrix": oracle.MATRIX_SQL,
    "entity_split": f"WITH {oracle.TRACKS_SQL}, u AS ({_flags}) SELECT s1_id, ('0x' || md5('42:' || s1_id)[1:8])::BIGINT % 10000 < 2000 AS validation, count(*) AS rows FROM u GROUP BY ALL",
    "violations": f"""WITH {oracle.PLANTED_SQL}, need AS (SELECT entity_id FROM ent WHERE source = 'S1' AND pos % 10 <> 7), known AS (SELECT entity_id FROM ent WHERE source <> 'S1' AND pos % 10 <> 3),
ids AS (SELECT DISTINCT unnest(string_split(m, ',')) AS id FROM planted WHERE m <> '')
SELECT 'duplicate row' AS rule, s AS id FROM planted GROUP BY s HAVING count(*) > 1
UNION ALL SELECT DISTINCT 'repeated id in list', s FROM planted WHERE len(string_split(m, ',')) <> len(list_distinct(string_split(m, ',')))
UNION ALL SELECT 'self match', id FROM ids WHERE id LIKE 'S1-%'
UNION ALL SELECT 'wrong prefix', id FROM ids WHERE id NOT LIKE 'S1-%' AND id NOT LIKE 'S2-%' AND id NOT LIKE 'S3-%'
UNION ALL SELECT 'missing entity', entity_id FROM need WHERE entity_id NOT IN (SELECT s FROM planted)
UNION ALL SELECT DISTINCT 'extra entity', s FROM planted WHERE s NOT IN (SELECT entity_id FROM need)
UNION ALL SELECT 'unknown id', id FROM ids WHERE (id LIKE 'S2-%' OR id LIKE 'S3-%') AND id NOT IN (SELECT entity_id FROM known)""",
    "fifteen_points": f"""WITH {oracle.PLANTED_SQL}, need AS (SELECT entity_id FROM ent WHERE source = 'S1'), known AS (SELECT entity_id FROM ent WHERE source <> 'S1'),
a AS (SELECT s, CASE WHEN m = '' THEN [] ELSE string_split(m, ',') END AS ids FROM planted),
b AS (SELECT source1_entity_id AS s, CASE WHEN candidate_entity_ids = '' THEN [] ELSE string_split(candidate_entity_ids, ',') END AS ids FROM lists),
ai AS (SELECT DISTINCT unnest(ids) AS id FROM a), bi AS (SELECT DISTINCT unnest(ids) AS id FROM b), ei AS (SELECT * FROM ai UNION SELECT * FROM bi),
p AS (SELECT [
  (SELECT count(*) FROM a) = (SELECT count(*) FROM need),
  NOT EXISTS (SELECT 1 FROM need WHERE entity_id NOT IN (SELECT s FROM a)),
  NOT EXISTS (SELECT 1 FROM a WHERE s NOT IN (SELECT entity_id FROM need)),
  (SELECT count(*) = count(DISTINCT s) FROM a),
  (SELECT count(*) FROM b) = (SELECT count(*) FROM need),
  NOT EXISTS (SELECT 1 FROM need WHERE entity_id NOT IN (SELECT s FROM b)) AND NOT EXISTS (SELECT 1 FROM b WHERE s NOT IN (SELECT entity_id FROM need)),
  (SELECT count(*) = count(DISTINCT s) FROM b),
  NOT EXISTS (SELECT 1 FROM (SELECT * FROM a UNION ALL SELECT * FROM b) WHERE len(ids) <> len(list_distinct(ids))),
  NOT EXISTS (SELECT 1 FROM ei WHERE id LIKE 'S1-%'),
  NOT EXISTS (SELECT 1 FROM ei WHERE id NOT LIKE 'S1-%' AND id NOT LIKE 'S2-%' AND id NOT LIKE 'S3-%'),
  NOT EXISTS (SELECT 1 FROM a LEFT JOIN b USING (s) WHERE len(list_filter(a.ids, lambda x: NOT list_contains(coalesce(b.ids, []), x))) > 0),
  NOT EXISTS (SELECT 1 FROM ai WHERE (id LIKE 'S2-%' OR id LIKE 'S3-%') AND id NOT IN (SELECT entity_id FROM known)),
  NOT EXISTS (SELECT 1 FROM bi WHERE (id LIKE 'S2-%' OR id LIKE 'S3-%') AND id NOT IN (SELECT entity_id FROM known)),
  true, 'candidates' = 'candidate_entity_ids'] AS x)
SELECT unnest(range(1, 16))::INTEGER AS rule, unnest(x) AS passed FROM p""",
}

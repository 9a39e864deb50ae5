"""Queries of the problems for training data, and oracle SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..runtime import load
from . import formatting, language, leakage, linkage, mapping, mixing, residue, survivors


def p4_found(spark, sf_dir):
    return residue.residue(load(spark, sf_dir, "programmes")).select("row_id")


def p4_kinds(spark, sf_dir):
    rows = load(spark, sf_dir, "programmes", ["row_id", "source", "title"])
    return rows.join(residue.residue(rows), "row_id").groupBy("source", "kind").agg(F.count("*").alias("n_rows"), F.round(F.avg("coverage"), 4).alias("mean_coverage"))


def p8_found(spark, sf_dir):
    return p8_spans(spark, sf_dir).select("doc_id", "item_id").distinct()


def p8_spans(spark, sf_dir):
    return leakage.leaks(load(spark, sf_dir, "documents"), load(spark, sf_dir, "eval_items"))


def p8_clean(spark, sf_dir):
    return leakage.without_leaks(load(spark, sf_dir, "documents"), p8_spans(spark, sf_dir))


def p10_found(spark, sf_dir):
    return language.unnamed_languages(language.segments(load(spark, sf_dir, "documents")))


def p10_segments(spark, sf_dir):
    s = language.segments(load(spark, sf_dir, "documents"))
    return s.withColumn("confidence", F.round("confidence", 4))


def _channel_tables(spark, sf_dir):
    return load(spark, sf_dir, "source_channels"), load(spark, sf_dir, "channel_dictionary")


def p2_found(spark, sf_dir):
    return linkage.pairs(*_channel_tables(spark, sf_dir)).select("row_a", "row_b")


def p2_pairs(spark, sf_dir):
    return linkage.pairs(*_channel_tables(spark, sf_dir))


def p2_classes(spark, sf_dir):
    return linkage.classes(*_channel_tables(spark, sf_dir))


def p2_rules(spark, sf_dir):
    r, precision = linkage.resolve(*_channel_tables(spark, sf_dir))
    return precision.join(r.groupBy("rule").agg(F.count("*").alias("n_records")), "rule", "left").fillna(0).withColumn("precision", F.round("precision", 6))


def p6_found(spark, sf_dir):
    return mapping.map_entries(load(spark, sf_dir, "playlist_entries"), load(spark, sf_dir, "channel_dictionary"))


def p6_unmapped(spark, sf_dir):
    return mapping.report(load(spark, sf_dir, "playlist_entries"), load(spark, sf_dir, "channel_dictionary"))


def p1_found(spark, sf_dir):
    return formatting.copies(load(spark, sf_dir, "dictionary_records"))


def p1_records(spark, sf_dir):
    return formatting.collapsed(load(spark, sf_dir, "dictionary_records")).select("first_id", "name", F.size("aliases").cast("bigint").alias("n_aliases"), "n_copies")


def _airings(spark, sf_dir):
    return load(spark, sf_dir, "candidate_rows"), load(spark, sf_dir, "sources")


def p7_found(spark, sf_dir):
    return survivors.best_rows(*_airings(spark, sf_dir))


def p7_merged(spark, sf_dir):
    m = survivors.merged(*_airings(spark, sf_dir))
    return m.withColumns({c: F.col(c).cast("string") for c in ("season", "episode")})


def p7_consensus(spark, sf_dir):
    return survivors.consensus(*_airings(spark, sf_dir))


def p9_report(spark, sf_dir):
    return mixing.report(load(spark, sf_dir, "documents"), load(spark, sf_dir, "mix_targets"))


def p9_copies(spark, sf_dir):
    return mixing.mix(load(spark, sf_dir, "documents"), load(spark, sf_dir, "mix_targets"))


QUERIES = {"p9_report": p9_report, "p9_copies": p9_copies, "p1_found": p1_found, "p1_records": p1_records, "p7_found": p7_found, "p7_merged": p7_merged, "p7_consensus": p7_consensus, "p6_found": p6_found, "p6_unmapped": p6_unmapped, "p2_found": p2_found, "p2_pairs": p2_pairs, "p2_rules": p2_rules, "p2_classes": p2_classes, "p10_found": p10_found, "p10_segments": p10_segments, "p8_found": p8_found, "p8_spans": p8_spans, "p8_clean": p8_clean, "p4_found": p4_found, "p4_kinds": p4_kinds}
_CANON = """
WITH c AS (SELECT rec_id, name, aliases, coalesce(lower(regexp_replace(name, '[^\\p{L}\\p{N}]', '', 'g')), chr(1)) AS n,
  list_sort(list_transform(coalesce(aliases, []), lambda a: coalesce(lower(regexp_replace(a, '[^\\p{L}\\p{N}]', '', 'g')), chr(1)))) AS l FROM dictionary_records),
g AS (SELECT n, l, min(rec_id) AS first_id, count(DISTINCT rec_id) AS n_copies FROM c GROUP BY n, l)
"""
_STAND_INS = ", ".join(f"'{x}'" for x in survivors.STAND_INS)
_VALUED = r"""
regexp_matches(v, '[\p{{L}}\p{{N}}]') AND NOT regexp_matches(v, '^\s*(\$?\{{\{{?[^{{}}]*\}}\}}?|<[^<>]*>|%[^%\s]*%|\[\[?[^\[\]]*\]\]?)\s*$')
AND strip_accents(lower(regexp_replace(v, '^[\s\p{{Z}}]+|[\s\p{{Z}}.!]+$', '', 'g'))) NOT IN ({0})
""".format(_STAND_INS)
_LONG = f"""
WITH r AS (SELECT c.*, coalesce(s.vote_weight, 0) AS w, coalesce(s.priority, 2147483647) AS p, count(*) OVER (PARTITION BY airing_id) AS n FROM candidate_rows c LEFT JOIN sources s ON s.key = c.source),
l AS ({" UNION ALL ".join(f"SELECT airing_id, row_id, w, p, n, fetched_at, '{f}' AS field, CAST({f} AS VARCHAR) AS v FROM r" for f in survivors.FIELDS)}),
o AS (SELECT *, row_number() OVER (PARTITION BY airing_id, field ORDER BY w DESC, p, fetched_at DESC NULLS LAST, row_id) AS k FROM l WHERE {_VALUED})
"""
ORACLE = {
    "p1_found": _CANON + "SELECT DISTINCT first_id, rec_id FROM c JOIN g USING (n, l) WHERE rec_id != first_id",
    "p1_records": _CANON + "SELECT first_id, c.name, CAST(len(c.aliases) AS BIGINT) AS n_aliases, n_copies FROM g JOIN c ON rec_id = first_id",
    "p7_found": _LONG + "SELECT airing_id, field, row_id FROM o WHERE k = 1 AND n >= 2",
    "p7_merged": _LONG + f"""SELECT airing_id, n_rows, {", ".join(f"max(v) FILTER (field = '{f}')" + f" AS {f}" for f in survivors.FIELDS)}
FROM (SELECT airing_id, count(*) AS n_rows FROM r GROUP BY 1) LEFT JOIN (SELECT * FROM o WHERE k = 1) USING (airing_id) GROUP BY 1, 2""",
}

#: Named entities of accented letters, which the database does not resolve by itself.
_LETTERS = {"acute": "aeiouAEIOU", "grave": "aeiouAEIOU", "circ": "aeiouAEIOU", "tilde": "anoANO", "uml": "aeiouAEIOU", "cedil": "cC"}
_TEXT = "text"
for _mark, _of in _LETTERS.items():
    for _l in _of:
        _TEXT = f"replace({_TEXT}, '&{_l}{_mark};', '{_l}')"
for _a, _b in (("&nbsp;", " "), ("&quot;", " "), ("&#39;", " "), ("&lt;", " "), ("&gt;", " "), ("&amp;", " ")):
    _TEXT = f"replace({_TEXT}, '{_a}', '{_b}')"
ORACLE["p8_found"] = f"""
WITH w AS (SELECT 0 AS side, doc_id AS id, regexp_extract_all(lower(strip_accents({_TEXT})), '[a-z0-9]+') AS w FROM documents UNION ALL SELECT 1, item_id, regexp_extract_all(lower(strip_accents({_TEXT})), '[a-z0-9]+') FROM eval_items),
g AS (SELECT side, id, array_to_string(w[k:k + 9], ' ') AS gram FROM (SELECT *, unnest(range(1, len(w) - 8)) AS k FROM w WHERE len(w) >= 10))
SELECT DISTINCT d.id AS doc_id, i.id AS item_id FROM g d JOIN g i USING (gram) WHERE d.side = 0 AND i.side = 1
"""

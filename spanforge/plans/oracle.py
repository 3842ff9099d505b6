"""DuckDB SQL of the queries, over the same projections."""

from __future__ import annotations

from spanforge.functions.sequence import BASES, COMPLEMENTS, LETTERS
from spanforge.operators.motifs import CLASSIC, MSP, TATA, USE
from spanforge.plans import projections as P

_SEQ = P.sequences_sql(False)
_HITS = f"hits AS ({P.TIERED})"
_FEATURES = f"features AS ({P.FEATURES})"
_OV = "greatest(0, least({a}end1, {b}end1) - greatest({a}start1, {b}start1) + 1)"


#: Best hit first.
_LEVEL = "CASE tier WHEN 'strong' THEN 3 WHEN 'moderate' THEN 2 WHEN 'weak' THEN 1 ELSE 0 END"
_RANK = f"coalesce(ga_pass, false) DESC, {_LEVEL} DESC, coalesce(score, bits, 0) DESC, coalesce(qcov, 0) DESC, coalesce(pident, 0) DESC, start1"
_ORDER = f"{_RANK}, id"


def _ov(a: str, b: str) -> str:
    return _OV.format(a=a, b=b)


def _islands(source: str) -> str:
    return f"""(SELECT *, max(opened) OVER (PARTITION BY seqid, strand ORDER BY start1, end1, id ROWS UNBOUNDED PRECEDING) AS island FROM
  (SELECT *, CASE WHEN coalesce(start1 > max(end1) OVER (PARTITION BY seqid, strand ORDER BY start1, end1, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) THEN start1 END AS opened FROM {source}))"""


#: The fold runs over whole groups: no islands.
_NMS = f"""ranked AS (SELECT *, row_number() OVER (PARTITION BY seqid, strand, method, query ORDER BY {_ORDER}) AS k FROM hits),
fold AS (SELECT seqid, strand, method, query, k, id, CAST(NULL AS VARCHAR) AS suppressed_by, [{{'id': id, 's': start1, 'e': end1}}] AS kept FROM ranked WHERE k = 1
  UNION ALL SELECT seqid, strand, method, query, k, id, covered, CASE WHEN covered IS NULL THEN list_append(kept, {{'id': id, 's': start1, 'e': end1}}) ELSE kept END FROM
    (SELECT r.*, f.kept, list_filter(f.kept, lambda x: greatest(0, least(r.end1, x.e) - greatest(r.start1, x.s) + 1) >= CAST(0.9 AS DOUBLE) * greatest(r.end1 - r.start1 + 1, x.e - x.s + 1))[1].id AS covered
     FROM fold f JOIN ranked r ON f.seqid = r.seqid AND f.strand = r.strand AND f.method = r.method AND f.query = r.query AND r.k = f.k + 1))"""
_CLUSTERED = f"NOT seed, CASE WHEN seed THEN start1 END, CASE WHEN seed THEN end1 END, {_ORDER}"


def _cluster(source: str, islands: bool = True) -> str:
    """Fold of hits: state is the list of clusters; sure and joined give each hit's anchor."""
    group, rows = ("seqid, strand, island", _islands(source)) if islands else ("seqid, strand", source)
    same = " AND ".join(f"s.{c} = p.{c}" for c in group.split(", "))
    return f"""placed AS (SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY {_CLUSTERED}) AS n, row_number() OVER (PARTITION BY {group} ORDER BY {_ORDER}) AS rk FROM {rows}),
steps AS (SELECT {group}, n, id, id AS anchor_id, 0 AS n_compatible, [{{'id': id, 'r': rk, 's': start1, 'e': end1, 'lo': start1, 'hi': end1}}] AS c FROM placed WHERE n = 1
  UNION ALL SELECT {group}, n, id, coalesce(best.id, id), len(found), CASE WHEN best IS NULL THEN list_append(c, {{'id': id, 'r': rk, 's': start1, 'e': end1, 'lo': start1, 'hi': end1}})
      ELSE list_transform(c, lambda x: CASE WHEN x.id = best.id THEN {{'id': x.id, 'r': x.r, 's': x.s, 'e': x.e, 'lo': least(x.lo, start1), 'hi': greatest(x.hi, end1)}} ELSE x END) END FROM
    (SELECT *, list_sort(found)[1] AS best FROM
      (SELECT p.*, s.c, CASE WHEN p.seed THEN [] ELSE list_transform(list_filter(s.c, lambda x: greatest(0, least(p.end1, x.e) - greatest(p.start1, x.s) + 1) >= 15
          AND greatest(0, least(p.end1, x.e) - greatest(p.start1, x.s) + 1) >= CAST(0.5 AS DOUBLE) * least(p.end1 - p.start1 + 1, x.e - x.s + 1)
          AND greatest(x.hi, p.end1) - least(x.lo, p.start1) + 1 <= greatest(140, x.e - x.s + 1)),
          lambda x: {{'o': -greatest(0, least(p.end1, x.e) - greatest(p.start1, x.s) + 1), 'r': x.r, 'id': x.id}}) END AS found
       FROM steps s JOIN placed p ON {same} AND p.n = s.n + 1)))"""


def _reciprocal(hits: str, others: str, order: str = "b.id") -> str:
    ov = _ov("a.", "b.")
    return f"""(SELECT id, other_id, overlap, n_compatible FROM (SELECT a.id, b.id AS other_id, {ov} AS overlap, row_number() OVER (PARTITION BY a.id ORDER BY {ov} DESC, {order}) AS k, count(*) OVER (PARTITION BY a.id) AS n_compatible FROM {hits} a JOIN {others} b
  ON a.seqid = b.seqid AND a.strand = b.strand AND a.start1 <= b.end1 AND b.start1 <= a.end1 AND {ov} >= 15 AND {ov} >= 0.5 * greatest(a.end1 - a.start1 + 1, b.end1 - b.start1 + 1)) WHERE k = 1)"""


def _pick(name: str, where: str, order: str) -> str:
    return f"{name} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY {order}) AS b FROM members WHERE {where}) WHERE b = 1)"


_COVERAGE = "qcov / 100"
_LOCI = f"""{_HITS}, {_NMS}, left_over AS (SELECT hits.* FROM hits JOIN fold USING (id) WHERE suppressed_by IS NULL),
family AS (SELECT *, coalesce(query = 'family' AND ga_pass, false) AS seed FROM left_over WHERE query <> 'other'), {_cluster("family")},
anchors AS (SELECT family.*, row_number() OVER (ORDER BY {_CLUSTERED}) AS place FROM family JOIN steps USING (id) WHERE anchor_id = id),
members AS (SELECT left_over.*, anchor_id, n_compatible FROM left_over JOIN steps USING (id)
  UNION ALL SELECT left_over.*, other_id, n_compatible FROM left_over JOIN {_reciprocal("(SELECT * FROM left_over WHERE query = 'other')", "anchors", "b.place")} USING (id)),
best AS (SELECT anchor_id, query, tier FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id, query ORDER BY {_ORDER}) AS b FROM members WHERE method = 'blastn') WHERE b = 1),
tiers AS (SELECT anchor_id, count(*) AS n_queries, count(*) FILTER (tier = 'strong') AS k, string_agg(query, ',' ORDER BY query) FILTER (tier = 'strong') AS names FROM best GROUP BY anchor_id),
{_pick("rf", "query = 'family'", "score DESC, id")}, {_pick("ot", "query = 'other'", "score DESC, id")}, {_pick("top", "method = 'blastn'", _ORDER)}, {_pick("hist", "method = 'blastn' AND query = 'N'", _ORDER)},
summary AS (SELECT anchor_id, min(start1) FILTER (query <> 'other') AS envelope_start1, max(end1) FILTER (query <> 'other') AS envelope_end1, count(*) FILTER (query <> 'other') AS n_hits,
  bool_or(n_compatible > 1) AS multi_anchor_conflict, string_agg(id, ',' ORDER BY id) AS hit_ids FROM members GROUP BY anchor_id),
wide AS (SELECT s.*, a.seqid, a.strand, a.start1, a.end1, a.query AS anchor_source, coalesce(n_queries, 0) AS n_queries, coalesce(k, 0) AS k, coalesce(names, '') AS names, coalesce(rf.ga_pass, false) AS fg, coalesce(ot.ga_pass, false) AS og,
  rf.id IS NOT NULL AS has_rf, rf.score AS rs, rf.evalue AS re, rf.qcov / 100 AS rc, rf.trunc AS rt, ot.score AS os, ot.evalue AS oe, top.query AS tq, top.pident AS tp, top.qcov AS tc, top.bits AS tb,
  CASE WHEN top.qstart = 1 THEN CASE WHEN top.strand = '+' THEN top.start1 ELSE top.end1 END END AS t5, hist.id AS hid, hist.qstart AS hq, hist.tier AS ht, CASE WHEN hist.strand = '+' THEN hist.start1 - hist.qstart + 1 ELSE hist.end1 + hist.qstart - 1 END AS hp, hist.gapopen AS hg, hist.subject_length AS hl,
  CASE WHEN coalesce(rf.qcov / 100 >= CAST(0.8 AS DOUBLE) AND rf.trunc = 'no', false) THEN 'rf' WHEN coalesce(top.qcov >= 90, false) THEN 'top' WHEN rf.id IS NOT NULL THEN 'rf' ELSE 'top' END AS choice,
  rf.start1 AS r1, rf.end1 AS r2, rf.query AS rq, top.start1 AS t1, top.end1 AS t2
  FROM summary s JOIN hits a ON a.id = s.anchor_id LEFT JOIN tiers USING (anchor_id) LEFT JOIN rf USING (anchor_id) LEFT JOIN ot USING (anchor_id) LEFT JOIN top USING (anchor_id) LEFT JOIN hist USING (anchor_id)),
loci AS MATERIALIZED (SELECT anchor_id AS id, seqid, strand, start1, end1, anchor_source, envelope_start1, envelope_end1, n_hits, CASE choice WHEN 'rf' THEN r1 ELSE t1 END AS body_start1, CASE choice WHEN 'rf' THEN r2 ELSE t2 END AS body_end1,
  CASE choice WHEN 'rf' THEN r2 - r1 ELSE t2 - t1 END + 1 AS body_length, CASE choice WHEN 'rf' THEN rq ELSE tq END AS body_source,
  CASE WHEN fg AND og THEN 'U6_U6atac_ambiguous' WHEN fg THEN 'RF00026_supported' WHEN og THEN 'RF00619_supported' WHEN k >= 1 THEN 'BLAST_supported_review' WHEN has_rf THEN 'below_GA_review' ELSE 'weak_evidence_review' END AS family_class,
  CASE WHEN fg AND og THEN 'B2_clan_ambiguous' WHEN fg AND k >= 2 THEN 'A1_concordant_U6' WHEN fg THEN 'A2_CM_led_U6' WHEN og THEN 'U6atac_like' WHEN k >= 2 AND has_rf THEN 'B1_subGA_supported'
    WHEN k >= 2 THEN 'C1_BLAST_only' WHEN k >= 1 THEN 'fragment_or_weak' WHEN rc >= CAST(0.7 AS DOUBLE) AND rt = 'no' THEN 'C2_lowCM_only' ELSE 'fragment_or_weak' END AS legacy_grade, fg AND NOT og AS canonical,
  coalesce(ht = 'strong', false) AND fg AND NOT og AS strict, tq AS best_query, t5 AS best_5p, tp AS best_pident, tc AS best_qcov, tb AS best_bits, n_queries, k AS strong_queries, names AS strong_names,
  CASE WHEN hq = 1 OR (hg = 0 AND hp BETWEEN 1 AND hl) THEN hp END AS q1_position, hq - 1 AS q1_missing, CASE WHEN hq IS NULL THEN 'not_available' WHEN hq = 1 THEN 'direct_query_position_1' WHEN hg > 0 THEN 'gapped_HSP_requires_alignment_review'
    WHEN hp BETWEEN 1 AND hl THEN 'provisional_linear_5prime_extrapolation' ELSE 'extrapolation_outside_reference' END AS q1_status, coalesce(hq = 1, false) AS q1_safe, hid AS historical_id,
  rs AS family_score, fg AS family_ga, re AS family_evalue, rc AS family_coverage, rt AS family_trunc, os AS other_score, og AS other_ga, oe AS other_evalue, multi_anchor_conflict, hit_ids FROM wide)"""

_RELATION = "CASE WHEN {a} IN ('+', '-') AND {b} IN ('+', '-') THEN CASE WHEN {a} = {b} THEN 'same' ELSE 'opposite' END ELSE 'unknown' END"
_MEET = "a.seqid = f.seqid AND a.start1 <= f.end1 AND f.start1 <= a.end1"


def _counts(regions: str, kinds: list[str]) -> str:
    rel = _RELATION.format(a="a.strand", b="f.strand")
    grid = " UNION ALL ".join(f"SELECT '{k}' AS kind" for k in kinds)
    return f"""(SELECT g.id, g.kind, {", ".join(f"CASE WHEN v.seqid IS NOT NULL THEN coalesce({c}, 0) END AS {c}" for c in ("n", "n_same", "n_opposite", "n_unknown"))} FROM (SELECT id, seqid, kind FROM {regions} CROSS JOIN ({grid})) g
  LEFT JOIN (SELECT DISTINCT seqid, kind FROM features) v ON v.seqid = g.seqid AND v.kind = g.kind
  LEFT JOIN (SELECT a.id, f.kind, count(*) AS n, count(*) FILTER ({rel} = 'same') AS n_same, count(*) FILTER ({rel} = 'opposite') AS n_opposite, count(*) FILTER ({rel} = 'unknown') AS n_unknown
    FROM {regions} a JOIN features f ON {_MEET} GROUP BY a.id, f.kind) c ON c.id = g.id AND c.kind = g.kind)"""


_REVCOMP = "reverse(translate({x}, '" + LETTERS + "', '" + COMPLEMENTS + "'))"
_BOUNDARY = "CAST(CASE id % 12 WHEN 0 THEN 0 WHEN 3 THEN length(seq) + 5 WHEN 6 THEN 1 WHEN 9 THEN length(seq) ELSE tss END AS INT)"
_WINDOWS = f"""seqs AS ({_SEQ}), placed_ AS (SELECT id, seq, strand, {_BOUNDARY} AS tss, unnest([300, 500, 1000]) AS size FROM seqs),
spans AS (SELECT *, tss BETWEEN 1 AND length(seq) AS inside, CASE WHEN strand = '+' THEN greatest(1, tss - size) ELSE tss + 1 END AS s1, CASE WHEN strand = '+' THEN tss - 1 ELSE least(length(seq), tss + size) END AS e1 FROM placed_),
windows AS (SELECT *, CASE WHEN inside AND e1 >= s1 THEN CASE WHEN strand = '+' THEN substr(seq, s1, e1 - s1 + 1) ELSE {_REVCOMP.format(x="substr(seq, s1, e1 - s1 + 1)")} END ELSE '' END AS w FROM spans)"""
_PROMOTERS = f"{_WINDOWS}, w500 AS (SELECT id, w FROM windows WHERE size = 500), promoters AS ({P.promoters_sql('w500')})"


def _mm(word: str, motif: str) -> str:
    return "(" + " + ".join(f"CASE WHEN substr({word}, {k}, 1) <> '' AND contains('{BASES[x]}', substr({word}, {k}, 1)) THEN 0 ELSE 1 END" for k, x in enumerate(motif, 1)) + ")"


def _motif(name: str, motif: str, low: int, high: int, most: int, source: str = "(SELECT id, w FROM windows WHERE size = 500)") -> str:
    m = len(motif)
    return f"""{name} AS (SELECT id, p AS start, {_mm(f"substr(w, p + length(w) + 1, {m})", motif)} AS mm FROM
  (SELECT id, w, unnest(range(greatest({low}, -length(w)), least({high}, -{m}) + 1)) AS p FROM {source}) WHERE {_mm(f"substr(w, p + length(w) + 1, {m})", motif)} <= {most})"""


_INPUT = "(SELECT id, seq AS w FROM promoters)"


def _scan(use: tuple[int, int], tata: tuple[int, int], legacy: bool) -> str:
    most = 99 if legacy else 3
    strict = "u.mm <= 1 AND t.mm <= 2 AND t.start BETWEEN -35 AND -25 AND t.start - u.start - 10 BETWEEN 24 AND 26"
    relaxed = "u.mm <= 2 AND t.mm <= 2 AND t.start - u.start - 10 BETWEEN 21 AND 29"
    name = "CASE pc WHEN 0 THEN 'P1_canonical_geometry' WHEN 1 THEN 'P2_near_canonical_geometry' WHEN 2 THEN 'P3_uncertain' END" if legacy else "CASE WHEN near_ AND amb = 0 THEN 'provisional_type3_like_geometry' WHEN use_start IS NOT NULL THEN 'provisional_uncertain_geometry' END"
    basis = "CASE WHEN pc < 2 THEN 'canonical_geometry_then_minimum_mismatch' WHEN pc = 2 THEN 'algorithm_minimum_mismatch_P3_not_a_functional_best_pair' END" if legacy else "CASE WHEN use_start IS NOT NULL THEN 'provisional_Arabidopsis_motif_heuristic_not_cross_plant_calibrated' END"
    reliable = "coalesce(pc < 2 AND amb = 0, false)" if legacy else "coalesce(near_ AND amb = 0, false)"
    return f"""WITH {_PROMOTERS}, {_motif("u", USE, *use, 99, _INPUT)}, {_motif("t", TATA, *tata, 99, _INPUT)}, {_motif("m", MSP, -100000, -1, 0, _INPUT)},
pairs AS (SELECT u.id, u.start AS use_start, t.start AS tata_start, u.mm AS use_mm, t.mm AS tata_mm, CASE WHEN {strict} THEN 0 WHEN {relaxed} THEN 1 ELSE 2 END AS pc, coalesce({relaxed}, false) AS near_ FROM u JOIN t ON u.id = t.id AND t.start > u.start + 10),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY pc, use_mm + tata_mm, abs(tata_start - use_start - 10 - 24.5), abs(use_start + 65.5) + abs(tata_start + 31), use_start, tata_start) AS k FROM pairs WHERE use_mm <= {most} AND tata_mm <= {most}) WHERE k = 1),
counts AS (SELECT id, count(*) FILTER (use_mm <= 3 AND tata_mm <= 3) AS n_pairs FROM pairs GROUP BY id),
wide AS (SELECT p.id, p.seq, b.*, substr(p.seq, length(p.seq) + use_start + 1, 11) AS us, substr(p.seq, length(p.seq) + tata_start + 1, 8) AS ts, coalesce(n_pairs, 0) AS n_pairs, EXISTS (SELECT 1 FROM u WHERE u.id = p.id) AS has_u, EXISTS (SELECT 1 FROM t WHERE t.id = p.id) AS has_t
  FROM promoters p LEFT JOIN (SELECT * EXCLUDE (k) FROM best) b USING (id) LEFT JOIN counts USING (id)),
full_ AS (SELECT *, length(translate(concat(us, ts), 'ACGT', '')) AS amb_ FROM wide), told AS (SELECT *, CASE WHEN use_start IS NOT NULL THEN amb_ END AS amb FROM full_), final AS (SELECT *, {reliable} AS reliable FROM told),
msps AS (SELECT f.id, string_agg(m.start || '..' || (m.start + 5), ',' ORDER BY m.start) AS hits FROM final f JOIN m USING (id) WHERE NOT reliable OR m.start + 5 < use_start GROUP BY f.id)
SELECT id, CASE WHEN length(seq) >= {-use[0]} THEN 'complete_window' WHEN has_u AND has_t THEN 'partial_window' ELSE 'insufficient_window' END AS scan_status, CASE WHEN reliable THEN 'paired_heuristic_evidence' ELSE 'uncertain_or_no_pair_not_U6_exclusion' END AS evidence_status,
  {name} AS pair_class, {basis} AS selection_basis, CASE WHEN use_start IS NOT NULL THEN us END AS use_sequence, use_start, use_start + 10 AS use_end, use_mm, CASE WHEN use_start IS NOT NULL THEN {_mm("us", CLASSIC)} END AS classic_mm,
  CASE WHEN use_start IS NOT NULL THEN ts END AS tata_sequence, tata_start, tata_start + 7 AS tata_end, tata_mm, tata_start - use_start AS start_separation, tata_start - use_start - 10 AS edge_distance, tata_start - use_start - 11 AS intervening_bases, tata_start - use_start - 1.5 AS center_distance,
  amb AS motif_ambiguous, n_pairs, coalesce(hits, '') AS msp_hits, CASE WHEN reliable THEN 'upstream_of_selected_USE' ELSE 'USE_relation_unresolved' END AS msp_relation, length(translate(seq, 'ACGT', '')) AS sequence_ambiguous FROM final LEFT JOIN msps USING (id)"""


_EDGES = f"edges AS ({P.EDGES})"
_CLOSURE = f"{_EDGES}, closure AS (SELECT id, parent AS ancestor FROM edges UNION SELECT closure.id, edges.parent FROM closure JOIN edges ON closure.ancestor = edges.id)"
_RUNS = f"""seqs AS ({_SEQ}), spots AS (SELECT id, seq, tss, unnest(range(1, length(seq) + 1)) AS i FROM seqs),
ts AS (SELECT id, seq, tss, i, i - row_number() OVER (PARTITION BY id ORDER BY i) AS g FROM spots WHERE substr(seq, i, 1) = 'T'),
runs AS (SELECT id, min(i) AS start, max(i) AS "end", max(i) = any_value(length(seq)) AS open FROM ts GROUP BY id, g HAVING count(*) >= 4)"""
#: Paired columns of the model, by its stems: outer and inner ends, counted inwards.
_STEMS = [(1 + k, 20 - k) for k in range(8)] + [(26 + k, 44 - k) for k in range(6)] + [(33 + k, 55 - k) for k in range(4)]
_KEPT = [(i, j) for i, j in _STEMS if i % 11 and j % 11]
_M = "concat(" + ", ".join(f"substr(aligned, {11 * k + 1}, 10)" for k in range(10)) + ")"
_INS = "concat(" + ", ".join(f"substr(aligned, {11 * k + 11}, 1)" for k in range(10)) + ")"
_FLAT = "translate(%s, '.-_~', '----')"
_METRICS = f"""rows_ AS ({P.blocks_sql(False)}), flat AS (SELECT *, {_FLAT % _M} AS m, translate({_INS}, '.-_~', '') AS ins, translate(upper(translate(aligned, '.-_~', '')), 'U', 'T') AS letters, {_FLAT % "translate(upper(aligned), 'T', 'U')"} AS u FROM rows_),
pairs_ AS (SELECT *, [{", ".join(f"concat(substr(u, {i}, 1), substr(u, {j}, 1))" for i, j in _KEPT)}] AS both_ FROM flat), seen_ AS (SELECT *, list_filter(both_, lambda x: NOT contains(x, '-')) AS seen, list_filter(both_, lambda x: regexp_full_match(x, '[ACGU]{{2}}')) AS ev,
  length(replace(m, '-', '')) AS occupied FROM pairs_), metrics AS (SELECT id, seq, pseudogene, length(letters) AS aligned_length, sha256(letters) AS aligned_sha256, 100 AS rf_columns, occupied, occupied / 100 AS occupancy, length(m) - length(ltrim(m, '-')) AS gap5,
  CASE WHEN occupied > 0 THEN length(m) - length(rtrim(m, '-')) ELSE 0 END AS gap3, CASE WHEN occupied > 0 THEN length(trim(m, '-')) - occupied ELSE 0 END AS interior_gaps,
  CASE WHEN occupied > 0 THEN list_max(list_transform(regexp_split_to_array(trim(m, '-'), '[^-]'), lambda x: length(x))) ELSE 0 END AS longest_interior_gap, length(ins) AS inserted, length(translate(letters, 'ACGT', '')) AS ambiguous, {len(_KEPT)} AS paired_positions,
  len(seen) AS paired_observed, len(ev) AS paired_evaluable, len(list_filter(ev, lambda x: x IN ('AU', 'UA', 'GC', 'CG', 'GU', 'UG'))) AS paired_compatible FROM seen_), whole AS (SELECT *, CASE WHEN paired_evaluable > 0 THEN paired_compatible / paired_evaluable END AS pair_compatibility FROM metrics)"""
_PAIR = "CASE WHEN u.mm <= 1 AND t.mm <= 2 AND t.start BETWEEN -35 AND -25 AND t.start - (u.start + 10) BETWEEN 24 AND 26 THEN 0 WHEN u.mm <= 2 AND t.mm <= 2 AND t.start - (u.start + 10) BETWEEN 21 AND 29 THEN 1 ELSE 2 END"
_ITEMS = P.sequences_sql(False, "benchmark", "item_id")
_OTHER, _REST = "(SELECT * FROM hits WHERE query = 'other')", "(SELECT * FROM hits WHERE query <> 'other')"

_GFF = f"""gff AS (SELECT * FROM ({P.GFF}) WHERE kind <> 'chromosome'), regions AS ({P.REGIONS}), lengths AS ({P.LENGTHS}),
parents AS (SELECT n, declared_id, p FROM (SELECT n, declared_id, unnest([parent1, parent2]) AS p FROM gff) WHERE p IS NOT NULL),
up AS (SELECT n, declared_id AS me, p AS ancestor FROM parents UNION SELECT up.n, up.me, parents.p FROM up JOIN parents ON parents.declared_id = up.ancestor), lines AS (SELECT DISTINCT n, ancestor FROM up WHERE ancestor IS DISTINCT FROM me),
owned AS (SELECT *, CASE WHEN biotype IS NOT NULL THEN [biotype] WHEN lower(kind) IN ('snrna', 'ncrna', 'u6_snrna') THEN [kind] ELSE CAST([] AS VARCHAR[]) END AS own, kind IN ('gene', 'pseudogene') AS is_gene, lower(kind) IN ('snrna', 'ncrna', 'u6_snrna') AS is_rna FROM gff),
passed AS (SELECT l.n, list_sort(list_distinct(flatten(list(o.own) FILTER (o.n IS NOT NULL)))) AS bio, list_sort(list_distinct(list(l.ancestor) FILTER (o.is_gene))) AS genes, list_sort(list_distinct(list(l.ancestor) FILTER (o.n IS NULL))) AS missing, list(l.ancestor) AS ancestors, string_agg(o.name, ' ') AS labels
  FROM lines l LEFT JOIN owned o ON o.declared_id = l.ancestor GROUP BY l.n),
wide AS (SELECT o.*, CASE WHEN len(own) > 0 THEN own ELSE coalesce(bio, []) END AS bio, coalesce(genes, []) AS genes, coalesce(missing, []) AS missing, coalesce(ancestors, []) AS ancestors, concat_ws(' ', name, biotype, labels) AS labels FROM owned o LEFT JOIN passed USING (n)),
full_ AS (SELECT *, {{cats}} AS cats, {{own}} AS own_cats, list_sort(list_distinct(CASE WHEN is_gene THEN list_append(genes, declared_id) ELSE genes END)) AS gene_ids FROM wide),
met AS (SELECT r.id, f.* FROM regions r JOIN full_ f ON r.seqid = f.seqid AND r.strand = f.strand AND r.start1 <= f.end1 AND f.start1 <= r.end1 WHERE is_rna AND declared_id IS NOT NULL),
own_ids AS (SELECT id, n, declared_id, seqid, strand, start1, end1 FROM met WHERE NOT regexp_matches(labels, '(?i)u6[ _-]?atac|RF00619') AND (kind = 'U6_snRNA' OR regexp_matches(labels, '(?i)(^|[^A-Za-z0-9])([A-Za-z]{{{{1,4}}}})?U6([^A-Za-z]|$)'))),
possible AS (SELECT DISTINCT o.id, g.declared_id AS parent FROM own_ids o JOIN lines l ON l.n = o.n JOIN full_ g ON g.declared_id = l.ancestor AND g.is_gene AND g.seqid = o.seqid AND g.strand = o.strand AND g.start1 = o.start1 AND g.end1 = o.end1 WHERE NOT list_contains(g.own, 'protein_coding')),
promoted AS (SELECT p.id, p.parent FROM possible p JOIN parents c ON c.p = p.parent LEFT JOIN own_ids o ON o.id = p.id AND o.declared_id = c.declared_id GROUP BY p.id, p.parent HAVING bool_and(o.id IS NOT NULL)),
self_ids AS (SELECT id, declared_id AS self_id FROM own_ids UNION SELECT id, parent FROM promoted)"""


def _cats(bio: str) -> str:
    tests = [("CDS", "kind = 'CDS'"), ("exon", "kind = 'exon'"), ("five_prime_UTR", "kind = 'five_prime_UTR'"), ("gene_span", "is_gene"), ("ncRNA", f"is_rna OR list_contains({bio}, 'snRNA') OR list_contains({bio}, 'ncRNA') OR list_contains({bio}, 'U6_snRNA')"), ("pseudogene", f"kind = 'pseudogene' OR list_contains({bio}, 'processed-pseudogene')"), ("repeat", "kind = 'repeat_region'"), ("transcript_span", "is_rna OR kind = 'mRNA'")]
    return "(SELECT CASE WHEN len(x) > 0 THEN x ELSE ['other'] END FROM (SELECT list_filter([" + ", ".join(f"CASE WHEN {cond} THEN '{name}' END" for name, cond in tests) + "], lambda y: y IS NOT NULL) AS x))"


_GFF = _GFF.format(cats=_cats("bio"), own=_cats("own"))
_STATUS = """status AS (SELECT r.*, CASE WHEN l.last IS NULL OR z.length IS NULL THEN 'seqid_mismatch' WHEN l.last > z.length THEN 'gff_coordinates_out_of_bounds' WHEN r.end1 < r.start1 OR r.end1 > z.length THEN 'invalid_region' END AS reason
  FROM regions r LEFT JOIN (SELECT seqid, max(end1) AS last FROM gff GROUP BY seqid) l USING (seqid) LEFT JOIN lengths z USING (seqid))"""
#: Own rows: depth of the test graph is two, so one step down from the resolved ids is the whole fixed point.
_OVERLAPS = f"""{_GFF}, {_STATUS}, trusted AS (SELECT DISTINCT s.id, self_id FROM self_ids s JOIN regions r USING (id) WHERE EXISTS (SELECT 1 FROM gff WHERE declared_id = self_id AND gff.seqid = r.seqid)),
below AS (SELECT t.id, c.n, (SELECT count(*) FROM parents p WHERE p.n = c.n) AS k, count(*) AS m FROM trusted t JOIN parents c ON c.p = t.self_id GROUP BY t.id, c.n), own_rows AS (SELECT t.id, n FROM trusted t JOIN gff ON declared_id = self_id UNION SELECT id, n FROM below WHERE k = m),
over_ AS (SELECT s.id, f.n, f.seqid, f.kind AS feature_type, coalesce(declared_id, 'line:' || f.n) AS feature_id, f.start1 AS f_start1, f.end1 AS f_end1, least(s.end1, f.end1) - greatest(s.start1, f.start1) + 1 AS overlap, (least(s.end1, f.end1) - greatest(s.start1, f.start1) + 1) / (s.end1 - s.start1 + 1) AS fraction, {_RELATION.format(a="s.strand", b="f.strand")} AS relation,
  f.cats, array_to_string(f.cats, '|') AS categories, array_to_string(gene_ids, '|') AS gene_ids, array_to_string(bio, '|') AS biotype, array_to_string(missing, '|') AS missing_parents, o.n IS NOT NULL AS is_self, len(list_intersect(ancestors, coalesce(t.ids, []))) > 0 AS shared_with_self
  FROM status s JOIN full_ f ON s.seqid = f.seqid AND s.start1 <= f.end1 AND f.start1 <= s.end1 LEFT JOIN own_rows o ON o.id = s.id AND o.n = f.n LEFT JOIN (SELECT id, list(self_id) AS ids FROM trusted GROUP BY id) t ON t.id = s.id WHERE reason IS NULL)"""

def _clip(low: str, high: str) -> str:
    """Positions low..high of seq, as far as it has them."""
    return f"substr(seq, greatest(1, {low}), greatest(0, least(length(seq), {high}) - greatest(1, {low}) + 1))"


_INTEGRITY = f"""WITH {_METRICS}, body AS (SELECT *, translate(upper(seq), 'U', 'T') AS b FROM whole), why AS (SELECT *, CASE WHEN aligned_length IS NULL THEN 'structural_alignment_missing_or_incomplete' WHEN aligned_length <> length(b) THEN 'alignment_sequence_length_mismatch'
    WHEN aligned_sha256 <> sha256(b) THEN 'alignment_sequence_checksum_mismatch' WHEN translate(b, 'ACGT', '') <> '' THEN 'ambiguous_reference_bases' END AS w,
  interior_gaps > 5 OR longest_interior_gap > 3 AS r1, gap5 > 5 OR gap3 > 5 AS r2, occupancy < CAST(0.9 AS DOUBLE) AS r3, length(b) NOT BETWEEN 80 AND 130 AS r4, coalesce(paired_evaluable >= 5 AND pair_compatibility < CAST(0.7 AS DOUBLE), false) AS r5 FROM body)
  SELECT id, concat_ws(';', w, CASE WHEN w IS NULL AND r1 THEN 'substantial_internal_model_column_deletion' END, CASE WHEN w IS NULL AND r2 THEN 'terminal_model_columns_missing_in_submitted_body' END, CASE WHEN w IS NULL AND r3 THEN 'RF_match_column_occupancy_below_0.90' END,
    CASE WHEN w IS NULL AND r4 THEN 'length_outside_pilot_80_130nt_review_window' END, CASE WHEN w IS NULL AND r5 THEN 'low_canonical_wobble_pair_compatibility' END, CASE WHEN pseudogene THEN 'annotated_pseudogene_requires_review' END) AS reasons,
  CASE WHEN w IS NOT NULL THEN 'unresolved' WHEN r1 THEN 'structural_deletion_risk' WHEN r2 THEN 'terminally_incomplete_submitted_body' WHEN r3 OR r4 OR r5 THEN 'atypical_alignment_requires_review' ELSE 'alignment_near_complete_not_functionally_validated' END AS status FROM why"""
_IS_GAP = "a IN ('.', '-', '_', '~')"


def _stems(structure: str) -> list[tuple[int, int]]:
    """Pairs of a structure line, by one stack a symbol."""
    stacks, out = {}, []
    for k, x in enumerate(structure, 1):
        if x in "<([{" or x.isupper():
            stacks.setdefault(x, []).append(k)
        elif x in ">)]}" or x.islower():
            out.append((stacks[x.upper() if x.islower() else "<([{"[">)]}".index(x)]].pop(), k))
    return out


def _by_model() -> str:
    columns = ", ".join(f"('{name}', {k}, {str(x not in '.-_~').lower()})" for name, (rf, _) in P.MODELS.items() for k, x in enumerate(rf, 1))
    stems = ", ".join(f"('{name}', {i}, {j})" for name, (rf, structure) in P.MODELS.items() for i, j in (_stems(structure) if structure else []) if rf[i - 1] not in ".-_~" and rf[j - 1] not in ".-_~")
    base = "translate(upper(substr(aligned, {0}, 1)), 'T.-_~', 'U----')"
    return f"""WITH rows_ AS MATERIALIZED (SELECT * FROM ({P.BY_MODEL.replace("{blocks}", P.blocks_sql(False))}) WHERE aligned IS NOT NULL), columns_(model, k, hit) AS (VALUES {columns}), stems(model, i, j) AS (VALUES {stems}),
letters AS (SELECT id, r.model, k, hit, substr(aligned, k, 1) AS a FROM rows_ r JOIN columns_ USING (model)),
flat AS (SELECT id, model, string_agg(CASE WHEN {_IS_GAP} THEN '-' ELSE 'x' END, '' ORDER BY k) FILTER (hit) AS m, count(*) FILTER (NOT hit AND NOT {_IS_GAP}) AS inserted, count(*) FILTER (NOT {_IS_GAP}) AS aligned_length,
  count(*) FILTER (NOT {_IS_GAP} AND upper(a) NOT IN ('A', 'C', 'G', 'T', 'U')) AS ambiguous, count(*) FILTER (hit) AS rf_columns, count(*) FILTER (hit AND NOT {_IS_GAP}) AS occupied FROM letters GROUP BY id, model),
met AS (SELECT id, {base.format("i")} || {base.format("j")} AS p FROM rows_ JOIN stems USING (model)),
told AS (SELECT id, count(*) AS paired_positions, count(*) FILTER (NOT contains(p, '-')) AS paired_observed, count(*) FILTER (regexp_full_match(p, '[ACGU]{{2}}')) AS paired_evaluable, count(*) FILTER (p IN ('AU', 'UA', 'GC', 'CG', 'GU', 'UG')) AS paired_compatible FROM met GROUP BY id)
SELECT f.id, model, aligned_length, rf_columns, occupied, CASE WHEN occupied = 0 THEN rf_columns ELSE strpos(m, 'x') - 1 END AS gap5, CASE WHEN occupied = 0 THEN 0 ELSE strpos(reverse(m), 'x') - 1 END AS gap3,
  CASE WHEN occupied = 0 THEN 0 ELSE length(trim(m, '-')) - occupied END AS interior_gaps, CASE WHEN occupied = 0 THEN 0 ELSE list_max(list_transform(string_split(trim(m, '-'), 'x'), lambda g: length(g))) END AS longest_interior_gap, inserted, ambiguous,
  coalesce(paired_positions, 0) AS paired_positions, coalesce(paired_observed, 0) AS paired_observed, coalesce(paired_evaluable, 0) AS paired_evaluable, coalesce(paired_compatible, 0) AS paired_compatible FROM flat f LEFT JOIN told t ON t.id = f.id"""


_BY_MODEL = _by_model()
#: The best local hit of each locus, from the reference's rules in coordinates of the sequence: hits of query N that share
#: half of the shorter with the body, cut to its window of 60 bases on either side; position 1 must be in the window.
_BOUNDED = f"""win AS MATERIALIZED (SELECT *, greatest(1, body_start1 - 60) AS low, least({P.TOTAL}, body_end1 + 60) AS high FROM loci),
shown AS (SELECT w.id, w.body_start1 AS b1, w.body_end1 AS b2, h.strand, h.start1 AS hs, h.end1 AS he, greatest(h.start1, low) AS g1, least(h.end1, high) AS g2, h.qstart, h.bits, h.qcov, h.id AS hid, h.tier = 'strong' AS strong
  FROM win w JOIN hits h ON h.seqid = w.seqid AND h.strand = w.strand AND h.start1 <= w.high AND w.low <= h.end1 WHERE h.method = 'blastn' AND h.query = 'N'),
chosen AS (SELECT *, CASE WHEN qstart = 1 AND strand = '+' AND g1 = hs THEN g1 WHEN qstart = 1 AND strand = '-' AND g2 = he THEN g2 END AS q1 FROM shown WHERE greatest(0, least(g2, b2) - greatest(g1, b1) + 1) >= 0.5 * least(g2 - g1 + 1, b2 - b1 + 1)
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY strong DESC, bits DESC, qcov DESC, hid) = 1),
bounded AS MATERIALIZED (SELECT w.*, CASE WHEN c.strong THEN c.q1 END AS direct, CASE WHEN w.strand = '+' THEN body_start1 ELSE body_end1 END AS edge,
  row_number() OVER (ORDER BY w.seqid, body_start1, body_end1, w.strand, w.id) AS number FROM win w LEFT JOIN chosen c ON c.id = w.id)"""


def _upstream(size: int, name: str) -> str:
    """Places of a window before tss: status, start, end under the name."""
    s, e = f"CASE WHEN strand = '+' THEN greatest(1, tss - {size}) ELSE tss + 1 END", f"CASE WHEN strand = '+' THEN tss - 1 ELSE least({P.TOTAL}, tss + {size}) END"
    return f"""{name} AS (SELECT id, seqid, CASE WHEN tss < 1 OR tss > {P.TOTAL} THEN 'boundary_outside_reference' WHEN e < s THEN 'no_upstream_sequence_at_reference_edge' WHEN e - s + 1 < {size} THEN 'truncated_reference_edge' ELSE 'complete' END AS status,
  CASE WHEN tss BETWEEN 1 AND {P.TOTAL} AND e >= s THEN s END AS start1, CASE WHEN tss BETWEEN 1 AND {P.TOTAL} AND e >= s THEN e END AS end1 FROM (SELECT *, {s} AS s, {e} AS e FROM ends WHERE canonical))"""


_OVER = "(SELECT r.id, count(f.kind) AS n FROM {0} r LEFT JOIN features f ON f.seqid = r.seqid AND f.start1 <= r.end1 AND r.start1 <= f.end1 WHERE r.start1 IS NOT NULL GROUP BY r.id)"
_PRIORITY = f"""WITH RECURSIVE {_LOCI}, {_FEATURES}, {_BOUNDED}, ends AS MATERIALIZED (SELECT *, coalesce(direct, edge) AS tss FROM bounded),
{_upstream(500, "promoter")}, {_upstream(120, "core")}, bodies AS (SELECT id, seqid, body_start1 AS start1, body_end1 AS end1 FROM bounded),
states AS MATERIALIZED ({_INTEGRITY}), active AS (SELECT DISTINCT b.id FROM bounded b JOIN hits h ON h.seqid = b.seqid AND h.strand = b.strand AND h.start1 = b.body_start1 AND h.end1 = b.body_end1 WHERE h.tier = 'strong'),
rows_ AS (SELECT e.id, tss, CASE WHEN direct IS NULL THEN 'search_body_5prime_hypothesis' ELSE 'aligned_historical_q1' END AS hypothesis, p.status AS promoter_status, p.start1 AS promoter_start1, p.end1 AS promoter_end1,
  b.n AS body_features, q.n AS promoter_features, c.n AS core_features, coalesce(s.status, 'unresolved') AS body_integrity, CASE WHEN a.id IS NULL THEN 'not_tested' ELSE 'provided_source_support' END AS activity, canonical, multi_anchor_conflict AS conflict
  FROM ends e LEFT JOIN promoter p ON p.id = e.id LEFT JOIN {_OVER.format("bodies")} b ON b.id = e.id LEFT JOIN {_OVER.format("promoter")} q ON q.id = e.id LEFT JOIN {_OVER.format("core")} c ON c.id = e.id
  LEFT JOIN states s ON s.id = (number % 1000) || '.0' LEFT JOIN active a ON a.id = e.id),
why AS (SELECT *, concat_ws(';', CASE WHEN core_features > 0 THEN 'core_overlap_requires_interpretation' END, CASE WHEN body_integrity <> 'alignment_near_complete_not_functionally_validated' THEN 'submitted_body_integrity_review' END,
  CASE WHEN conflict THEN 'multiple_anchor_evidence_review' END, CASE WHEN promoter_status IS DISTINCT FROM 'complete' THEN 'upstream_extraction_incomplete' END) AS w FROM rows_)
SELECT * EXCLUDE (w, canonical, conflict), CASE WHEN NOT canonical THEN 'family_review_required' WHEN w <> '' THEN 'review_before_experimental_selection' WHEN activity <> 'not_tested' THEN 'review_source_supported_candidate' ELSE 'candidate_for_comparison' END AS priority,
  CASE WHEN NOT canonical THEN '' WHEN w <> '' THEN w WHEN activity <> 'not_tested' THEN 'provided_activity_source_not_independently_verified_by_pipeline' ELSE 'activity_not_tested;PCR_uniqueness_and_homeologs_not_assessed' END AS reasons FROM why"""
SQL: dict[str, str] = {
    "q01_support_tier": f"SELECT tier, count(*) AS n FROM ({P.TIERED}) GROUP BY tier",
    "q02_rank_argmax": f"SELECT seqid, query, id, tier FROM (SELECT *, row_number() OVER (PARTITION BY seqid, query ORDER BY {_ORDER}) AS k FROM ({P.TIERED})) WHERE k = 1",
    "q03_suppress": f"WITH RECURSIVE {_HITS}, {_NMS} SELECT id, suppressed_by FROM fold",
    "q04_overlap_pairs": f"WITH {_HITS}, {_FEATURES} SELECT id, kind, f.start1 AS f_start1, f.end1 AS f_end1, {_ov('a.', 'f.')} AS overlap FROM hits a JOIN features f ON {_MEET}",
    "q05_reciprocal": f"WITH {_HITS} SELECT id, other_id, overlap FROM {_reciprocal(_OTHER, _REST)}",
    "q06_standalone": f"WITH {_HITS} SELECT id FROM hits WHERE query = 'other' AND id NOT IN (SELECT id FROM {_reciprocal(_OTHER, _REST)})",
    "q07_islands": f"WITH {_HITS} SELECT seqid, strand, island, count(*) AS n, max(end1) AS end1 FROM {_islands('hits')} GROUP BY ALL",
    "q08_anchor_clusters": f"WITH RECURSIVE {_HITS}, family AS (SELECT *, coalesce(query = 'family' AND ga_pass, false) AS seed FROM hits WHERE query <> 'other'), {_cluster('family', False)} SELECT id, anchor_id, n_compatible FROM steps",
    "q09_loci": f"WITH RECURSIVE {_LOCI} SELECT * FROM loci",
    "q10_class_counts": f"WITH RECURSIVE {_LOCI} SELECT family_class, legacy_grade, count(*) AS n, count(*) FILTER (canonical) AS canonical, min(envelope_start1) AS first, max(envelope_end1) AS last FROM loci GROUP BY ALL",
    "q11_locus_ids": f"""WITH RECURSIVE {_LOCI}, n AS (SELECT *, row_number() OVER (ORDER BY seqid, body_start1, body_end1, strand, id) AS k FROM loci)
  SELECT 'TDU6L' || format('{{:04d}}', k) AS locus_id, seqid, body_start1 - 1 AS bed_start, body_end1 AS bed_end, strand, legacy_grade FROM n WHERE canonical""",
    "q12_upstream": f"""WITH {_WINDOWS} SELECT id, size, CASE WHEN NOT inside THEN 'boundary_outside_reference' WHEN w = '' THEN 'no_upstream_sequence_at_reference_edge' WHEN length(w) < size THEN 'truncated_reference_edge' ELSE 'complete' END AS status, md5(w) AS window_md5,
  CASE WHEN w <> '' THEN s1 END AS start1, CASE WHEN w <> '' THEN e1 END AS end1, length(w) < size AS truncated, CASE WHEN w <> '' THEN -length(w) END AS first_position, length(w) - length(replace(w, 'N', '')) AS n_count, length(translate(w, 'ACGT', '')) AS ambiguous FROM windows""",
    "q13_reverse_complement": f"SELECT id, sha256({_REVCOMP.format(x='seq')}) AS sha256 FROM ({_SEQ})",
    "q14_composition": f"SELECT id, length(seq) AS length, {', '.join(f'''length(seq) - length(replace(seq, '{x}', '')) AS n_{x.lower()}''' for x in 'ACGTN')} FROM ({_SEQ})",
    "q15_motif_hits": f"WITH {_WINDOWS}, {_motif('m', TATA, -120, -15, 4)} SELECT id, start, mm FROM m",
    "q16_best_pairs": f"""WITH {_PROMOTERS}, {_motif('u', USE, -120, -40, 3, _INPUT)}, {_motif('t', TATA, -55, -15, 3, _INPUT)}, pairs AS (SELECT u.id, u.start AS use_start, t.start AS tata_start, {_PAIR} AS pair_class, u.mm AS use_mm, t.mm AS tata_mm, t.start - (u.start + 10) AS edge
  FROM u JOIN t ON u.id = t.id AND t.start > u.start + 10) SELECT id, use_start, tata_start, pair_class, use_mm, tata_mm, edge FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY pair_class, use_mm + tata_mm, abs(edge - 24.5), abs(use_start + 65.5) + abs(tata_start + 31), use_start, tata_start) AS k FROM pairs) WHERE k = 1""",
    "q17_exact_motif": f"WITH {_WINDOWS}, {_motif('m', MSP, -500, -1, 0)} SELECT id, start FROM m",
    "q18_runs": f'WITH {_RUNS} SELECT id, start, "end", open FROM runs',
    "q19_termination": f"""WITH {_RUNS}, spans AS (SELECT id, seq, span, greatest(1, span - 15) AS low, span + 30 AS high, least(length(seq), span + 30) AS seen FROM (SELECT *, greatest(1, tss - 40) AS span FROM seqs)),
  met AS (SELECT s.id, r.start, r."end", r.open, s.span, r.start || ':' || r."end" AS told, r.start BETWEEN s.low AND s.seen AS expected, r."end" < s.low AS internal, r.start <= s.span AS body, r."end" >= s.low AND r.start <= s.seen AS window_ FROM spans s JOIN runs r USING (id)),
  sums AS (SELECT id, count(*) FILTER (expected) AS n, count(*) AS n_runs, bool_or(open) AS censored, min({{'d': abs(start - span + 3), 's': start, 'e': "end"}}) FILTER (expected) AS best, {", ".join(f"string_agg(told, ',' ORDER BY start) FILTER ({c}) AS l{c}" for c in ("expected", "internal", "body", "window_"))} FROM met GROUP BY id)
  SELECT s.id, CASE WHEN n > 0 THEN 'yes' WHEN length(seq) >= high AND translate(substr(seq, low, greatest(0, seen - low + 1)), 'ACGT', '') = '' THEN 'no' ELSE 'not_fully_assessable' END AS state, best.s AS terminator_start, best.e AS terminator_end,
  CASE WHEN length(seq) >= high THEN 'complete_window' WHEN seen >= low THEN 'partial_window' ELSE 'unavailable_window' END AS scan_status, low || '..' || high AS requested_window, length(translate(substr(seq, low, greatest(0, seen - low + 1)), 'ACGT', '')) AS ambiguous,
  coalesce(lexpected, '') AS expected, coalesce(linternal, '') AS internal, coalesce(lbody, '') AS body_overlapping, coalesce(lwindow_, '') AS window_overlapping, coalesce(n_runs, 0) AS n_runs, coalesce(censored, false) AS right_censored FROM spans s LEFT JOIN sums USING (id)""",
    "q20_position_map": f"""WITH s AS (SELECT id, translate(seq, 'A', '-') AS q, translate(seq, 'C', '-') AS s, CAST(floor(length(replace(translate(seq, 'A', '-'), '-', '')) / 2) AS INT) AS mid FROM ({_SEQ})), p AS (SELECT id, mid, unnest(range(1, length(q) + 1)) AS k, unnest(string_split(q, '')) <> '-' AS a, unnest(string_split(s, '')) <> '-' AS b FROM s),
  c AS (SELECT id, mid, a, b, sum(CAST(a AS INT)) OVER w AS qn, sum(CAST(b AS INT)) OVER w AS sn FROM p WINDOW w AS (PARTITION BY id ORDER BY k ROWS UNBOUNDED PRECEDING)),
  f AS (SELECT id, max(sn) FILTER (a AND b AND qn = 20) AS position, max(sn) FILTER (a AND b AND qn = mid) AS middle FROM c GROUP BY id) SELECT s.id, position, middle FROM s LEFT JOIN f USING (id)""",
    "q21_ancestors": f"WITH RECURSIVE {_CLOSURE} SELECT id, count(*) AS n_ancestors, min(ancestor) AS first_ancestor, max(ancestor) AS last_ancestor FROM closure GROUP BY id",
    "q22_inherited": f"""WITH RECURSIVE {_CLOSURE}, own AS (SELECT 'c' || c_custkey AS id, CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END AS value FROM customer UNION ALL SELECT 'o' || o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN o_orderstatus END FROM orders),
  passed AS (SELECT closure.id, string_agg(DISTINCT value, ',' ORDER BY value) AS v FROM closure JOIN own ON own.id = ancestor WHERE value IS NOT NULL GROUP BY closure.id),
  mine AS (SELECT id, string_agg(DISTINCT value, ',' ORDER BY value) AS v FROM own GROUP BY id) SELECT id, coalesce(mine.v, passed.v) AS value FROM mine LEFT JOIN passed USING (id)""",
    "q23_all_paths_self": f"""WITH {_EDGES}, seeds AS (SELECT 'n' || n_nationkey AS id FROM nation WHERE n_nationkey % 3 = 0),
  one AS (SELECT id FROM seeds UNION SELECT id FROM edges e WHERE NOT EXISTS (SELECT 1 FROM edges x WHERE x.id = e.id AND x.parent NOT IN (SELECT id FROM seeds))),
  two AS (SELECT id FROM one UNION SELECT id FROM edges e WHERE NOT EXISTS (SELECT 1 FROM edges x WHERE x.id = e.id AND x.parent NOT IN (SELECT id FROM one))),
  three AS (SELECT id FROM two UNION SELECT id FROM edges e WHERE NOT EXISTS (SELECT 1 FROM edges x WHERE x.id = e.id AND x.parent NOT IN (SELECT id FROM two))) SELECT id FROM three""",
    "q24_context_counts": f"WITH {_HITS}, {_FEATURES}, regions AS (SELECT * FROM hits WHERE query = 'family') SELECT * FROM {_counts('regions', P.KINDS)}",
    "q25_orphans": f"WITH {_EDGES} SELECT DISTINCT parent FROM edges WHERE parent NOT IN (SELECT id FROM edges UNION SELECT 'r' || r_regionkey FROM region)",
    "q26_strand_relation": f"WITH {_HITS}, {_FEATURES} SELECT kind, {_RELATION.format(a='a.strand', b='f.strand')} AS relation, count(*) AS n FROM hits a JOIN features f ON {_MEET} GROUP BY ALL",
    "q27_review_union": f"""WITH RECURSIVE {_LOCI} SELECT id, seqid, start1, family_class, 'noncanonical_locus' AS evidence_set FROM loci WHERE NOT canonical
  UNION ALL SELECT id, seqid, start1, NULL, 'standalone_competitor' FROM hits WHERE query = 'other' AND id NOT IN (SELECT id FROM {_reciprocal(_OTHER, _REST)})""",
    "q28_set_equality": f"WITH {_HITS}, d AS (SELECT id, start1 FROM hits EXCEPT ALL SELECT id, start1 FROM hits WHERE tier <> 'weak'), e AS (SELECT id, start1 FROM hits WHERE tier <> 'weak' EXCEPT ALL SELECT id, start1 FROM hits) SELECT side, count(*) AS n FROM (SELECT 'only_all' AS side FROM d UNION ALL SELECT 'only_part' FROM e) GROUP BY side",
    "q29_exact_evidence": f"""WITH RECURSIVE {_LOCI} SELECT l.id, coalesce(string_agg(h.id, ',' ORDER BY h.id), '') AS evidence FROM (SELECT * FROM loci WHERE canonical) l LEFT JOIN (SELECT * FROM hits WHERE tier IN ('strong', 'moderate', 'none')) h
  ON h.seqid = l.seqid AND h.strand = l.strand AND h.start1 = l.body_start1 AND h.end1 = l.body_end1 GROUP BY l.id""",
    "q30_nested_windows": f"WITH {_WINDOWS} SELECT a.id, suffix(b.w, a.w) AND suffix(c.w, b.w) AS nested FROM windows a JOIN windows b USING (id) JOIN windows c USING (id) WHERE a.size = 300 AND b.size = 500 AND c.size = 1000",
    "q31_integrity": _INTEGRITY,
    "q34_kmer_seeds": f"""WITH a AS (SELECT DISTINCT id, substr(seq, spot, 7) AS word FROM (SELECT id, seq, unnest(range(1, length(seq) - 5)) AS spot FROM ({_SEQ}))), b AS (SELECT DISTINCT id, substr(seq, spot, 7) AS word FROM (SELECT id, seq, unnest(range(1, length(seq) - 5)) AS spot FROM ({_ITEMS})))
  SELECT a.id, b.id AS item_id, count(*) AS n_words FROM a JOIN b USING (word) WHERE translate(word, 'ACGT', '') = '' GROUP BY ALL""",
    "q32_priority": _PRIORITY,
    "q33_alignment_metrics": f"WITH {_METRICS} SELECT * EXCLUDE (seq, pseudogene) FROM whole WHERE aligned_length IS NOT NULL",
    "q35_motif_scan": _scan((-90, -45), (-42, -18), True),
    "q36_motif_scan_generic": _scan((-120, -40), (-55, -15), False),
    "q37_related_windows": f"""WITH s AS (SELECT *, tss - 60 AS a, tss - 10 AS b FROM ({_SEQ})), t AS (SELECT *, CASE WHEN strand = '+' THEN a ELSE b END AS t FROM s),
  cuts AS (SELECT id, strand, t, a, b, greatest(1, a - 60) AS low, least(length(seq), b + 60) AS high, {_clip("a", "b")} AS c1, {_clip("a - 60", "b + 60")} AS c2, {_clip("t", "t")} AS c3,
    CASE WHEN strand = '+' THEN {_clip("t", "b + 60")} ELSE {_clip("a - 60", "t")} END AS c4 FROM t)
  SELECT id, md5(CASE WHEN strand = '+' THEN c1 ELSE {_REVCOMP.format(x="c1")} END) AS body_md5, md5(CASE WHEN strand = '+' THEN c2 ELSE {_REVCOMP.format(x="c2")} END) AS flanked_md5, low, high, CASE WHEN strand = '+' THEN c3 ELSE {_REVCOMP.format(x="c3")} END AS plus1,
    md5(CASE WHEN strand = '+' THEN c4 ELSE {_REVCOMP.format(x="c4")} END) AS context_md5, CASE WHEN strand = '+' THEN b - t + 1 ELSE t - a + 1 END AS span FROM cuts""",
    "q38_evidence_loci": f"""WITH RECURSIVE {_LOCI} SELECT f.id, m.anchor_id AS locus_id FROM fold f LEFT JOIN members m ON m.id = coalesce(f.suppressed_by, f.id)""",
    "q39_self_ids": f"WITH RECURSIVE {_GFF} SELECT * FROM self_ids",
    "q40_audit_status": f"WITH RECURSIVE {_GFF}, {_STATUS} SELECT id, CASE WHEN reason IS NULL THEN 'assessed' ELSE 'context_not_assessed' END AS status, reason FROM status",
    "q41_audit_overlaps": f"WITH RECURSIVE {_OVERLAPS} SELECT * EXCLUDE (seqid, cats) FROM over_",
    "q42_audit_counts": f"""WITH RECURSIVE {_OVERLAPS}, c AS (SELECT id, kind, count(*) AS n, count(*) FILTER (relation = 'same') AS n_same, count(*) FILTER (relation = 'opposite') AS n_opposite, count(*) FILTER (relation = 'unknown') AS n_unknown FROM (SELECT id, relation, unnest(cats) AS kind FROM over_ WHERE NOT is_self) GROUP BY ALL),
  there AS (SELECT DISTINCT seqid, unnest(own_cats) AS kind FROM full_), grid AS (SELECT id, seqid, reason, kind FROM status CROSS JOIN (SELECT unnest(['gene_span', 'transcript_span', 'pseudogene', 'exon', 'CDS', 'five_prime_UTR', 'three_prime_UTR', 'ncRNA', 'repeat', 'other']) AS kind))
  SELECT g.id, g.kind, {", ".join(f"CASE WHEN reason IS NULL AND (t.kind IS NOT NULL OR c.n IS NOT NULL) THEN coalesce(c.{x}, 0) END AS {x}" for x in ("n", "n_same", "n_opposite", "n_unknown"))} FROM grid g LEFT JOIN there t ON t.seqid = g.seqid AND t.kind = g.kind LEFT JOIN c ON c.id = g.id AND c.kind = g.kind""",
    "q43_resolve_ids": f"""WITH RECURSIVE {_GFF}, wanted AS (SELECT 'w' || n AS id, seqid, coalesce(name, declared_id, 'none') AS self_id FROM ({P.GFF})), c AS (SELECT DISTINCT w.id, w.seqid, w.self_id, d.declared_id AS c FROM wanted w JOIN gff d ON d.seqid = w.seqid AND (d.declared_id = w.self_id OR (d.declared_id IS NOT NULL AND d.name = w.self_id AND NOT EXISTS (SELECT 1 FROM gff x WHERE x.declared_id = w.self_id)))),
  one AS (SELECT id, any_value(c) AS resolved FROM c GROUP BY id HAVING count(*) = 1) SELECT id, self_id, resolved FROM wanted LEFT JOIN one USING (id)""",
    "q44_internal_checks": f"""WITH RECURSIVE {_LOCI}, c AS (SELECT count(*) FILTER (NOT (body_start1 >= envelope_start1 AND body_end1 <= envelope_end1)) AS a, count(*) FILTER (canonical AND NOT family_ga) AS b, count(*) FILTER (strict AND NOT canonical) AS c, count(*) FILTER (body_length <> body_end1 - body_start1 + 1) AS d,
  count(*) FILTER (n_queries = 0) AS e FROM loci) SELECT check_ AS "check", n = 0 AS passed, n AS n_failed FROM (SELECT unnest(['body_inside_envelope', 'canonical_passes', 'strict_is_canonical', 'length_is_span', 'one_query_at_least']) AS check_, unnest([a, b, c, d, e]) AS n FROM c)""",
    "q45_boundaries": f"""WITH RECURSIVE {_LOCI}, {_BOUNDED} SELECT id, 'aligned_historical_q1' AS hypothesis, true AS is_primary, direct AS tss FROM bounded WHERE canonical AND direct IS NOT NULL
  UNION ALL SELECT id, 'search_body_5prime_hypothesis', direct IS NULL, edge FROM bounded WHERE canonical""",
    "q46_known_cases": f"""WITH {_HITS}, {_FEATURES}, cases AS (SELECT DISTINCT concat_ws(':', seqid, strand, start1, end1) AS case_id, seqid, strand, start1, end1 FROM features WHERE kind = 'exon' AND strand <> '.')
  SELECT case_id, count(h.id) AS n_found, CASE WHEN count(h.id) = 1 THEN min(h.id) END AS found FROM cases c LEFT JOIN (SELECT * FROM hits WHERE tier = 'strong') h ON h.seqid = c.seqid AND h.strand = c.strand AND h.start1 <= c.end1 AND c.start1 <= h.end1 GROUP BY case_id""",
    "q47_activity_geometry": f"SELECT CASE WHEN id % 3 <> 0 THEN 'activity_not_tested' WHEN pair_class IS NOT DISTINCT FROM 'provisional_type3_like_geometry' THEN 'source_support_and_geometry_are_separate' ELSE 'experiment_supported_noncanonical_geometry' END AS interpretation, count(*) AS n FROM ({_scan((-120, -40), (-55, -15), False)}) GROUP BY ALL",
    "q48_declared_regions": f"""WITH features AS ({P.GFF}), lengths AS ({P.LENGTHS}), declared AS ({P.DECLARED}),
  runs AS (SELECT seqid, min(start1) AS s, max(end1) AS e FROM (SELECT *, sum(opens) OVER (PARTITION BY seqid ORDER BY start1, end1 ROWS UNBOUNDED PRECEDING) AS run FROM
    (SELECT *, CASE WHEN start1 <= 1 + max(end1) OVER (PARTITION BY seqid ORDER BY start1, end1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS opens FROM declared)) GROUP BY seqid, run),
  r AS (SELECT seqid, count(*) AS n_runs, sum(e - s + 1) AS covered FROM runs GROUP BY seqid), d AS (SELECT seqid, count(*) AS n FROM declared GROUP BY seqid),
  f AS (SELECT seqid, count(*) AS n, count(*) FILTER (NOT EXISTS (SELECT 1 FROM runs u WHERE u.seqid = x.seqid AND u.s <= x.start1 AND x.end1 <= u.e)) AS n_outside FROM features x GROUP BY seqid)
  SELECT l.seqid, l.length, coalesce(d.n, 0) AS n_declared, coalesce(n_runs, 0) AS n_runs, l.length - coalesce(covered, 0) AS uncovered, coalesce(covered, 0) = l.length AS covered_whole, coalesce(f.n, 0) AS n_features, coalesce(n_outside, 0) AS n_outside
  FROM lengths l LEFT JOIN r USING (seqid) LEFT JOIN d USING (seqid) LEFT JOIN f USING (seqid)""",
    "q50_metrics_by_model": _BY_MODEL,
}

"""Queries over the test tables, one or more for each operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanforge.functions import sequence as S
from spanforge.operators import annotation, curation, greedy, integrity, intervals, motifs, seeds, support
from spanforge.operators import loci as L
from spanforge.plans import oracle
from spanforge.plans import projections as P
from spanforge.sources import audits

PLACE = ["id", "seqid", "strand", "start1", "end1"]


def q01_support_tier(spark, d: str) -> DataFrame:
    tier = support.support_tier(F.col("method"), F.col("pident"), F.col("qcov"), F.col("bits"))
    return P.table(spark, d, P.HITS, "lineitem").groupBy(tier.alias("tier")).agg(F.count("*").alias("n"))


def q02_rank_argmax(spark, d: str) -> DataFrame:
    return support.best_by(P.hits(spark, d), "seqid", "query").select("seqid", "query", "id", "tier")


def q03_suppress(spark, d: str) -> DataFrame:
    return greedy.suppress(P.hits(spark, d).select(*PLACE, "method", "query", *[c for c in support.RANKED if c != "ordinal"])).select("id", "suppressed_by")


def q04_overlap_pairs(spark, d: str) -> DataFrame:
    a = P.hits(spark, d)
    b = P.features(spark, d).toDF("seqid", "f_strand", "f_start1", "f_end1", "kind")
    pairs = intervals.overlap_join(a, b, ["seqid"], ("start1", "end1", "f_start1", "f_end1"))
    return pairs.select("id", "kind", "f_start1", "f_end1", intervals.overlap_length(F.col("start1"), F.col("end1"), F.col("f_start1"), F.col("f_end1")).alias("overlap"))


def _two(spark, d: str) -> tuple[DataFrame, DataFrame]:
    h = P.hits(spark, d)
    return h.where("query = 'other'").select(*PLACE), h.where("query <> 'other'").select(*PLACE)


def q05_reciprocal(spark, d: str) -> DataFrame:
    return intervals.best_reciprocal(*_two(spark, d)).where("other_id is not null").select("id", "other_id", "overlap")


def q06_standalone(spark, d: str) -> DataFrame:
    return intervals.unmatched(*_two(spark, d)).select("id")


def q07_islands(spark, d: str) -> DataFrame:
    found = intervals.islands(P.hits(spark, d))
    return found.groupBy("seqid", "strand", "island").agg(F.count("*").alias("n"), F.max("end1").alias("end1"))


def q08_anchor_clusters(spark, d: str) -> DataFrame:
    h = P.hits(spark, d).where("query <> 'other'").withColumn("seed", F.coalesce((F.col("query") == "family") & F.col("ga_pass"), F.lit(False)))
    return greedy.anchor_clusters(h)


def q09_loci(spark, d: str) -> DataFrame:
    return L.loci(P.hits(spark, d))


def q10_class_counts(spark, d: str) -> DataFrame:
    return L.loci(P.hits(spark, d)).groupBy("family_class", "legacy_grade").agg(F.count("*").alias("n"), F.count_if("canonical").alias("canonical"), F.min("envelope_start1").alias("first"), F.max("envelope_end1").alias("last"))


def q11_locus_ids(spark, d: str) -> DataFrame:
    """Ids and BED places of canonical loci: numbers are by body, over all loci."""
    named = L.numbered(L.loci(P.hits(spark, d))).where("canonical")
    return named.select(F.format_string("TDU6L%04d", "number").alias("locus_id"), "seqid", (F.col("body_start1") - 1).alias("bed_start"), F.col("body_end1").alias("bed_end"), "strand", "legacy_grade")


#: Every third boundary is moved out of its sequence or to its edge.
BOUNDARY = "CASE id % 12 WHEN 0 THEN 0 WHEN 3 THEN length(seq) + 5 WHEN 6 THEN 1 WHEN 9 THEN length(seq) ELSE tss END"


def _windows(spark, d: str, *sizes: int) -> DataFrame:
    """id, size and the upstream window of each size; its struct is bound once a row."""
    seqs = P.sequences(spark, d).withColumn("tss", F.expr(f"CAST({BOUNDARY} AS INT)"))
    each = F.transform(F.array(*map(F.lit, sizes)), lambda k: F.struct(k.alias("size"), S.upstream(F.col("seq"), F.col("strand"), F.col("tss"), k).alias("w")))
    return seqs.select("id", F.inline(each)).select("id", "size", "w.*")


def q12_upstream(spark, d: str) -> DataFrame:
    return _windows(spark, d, 300, 500, 1000).select("id", "size", "status", F.md5("seq").alias("window_md5"), "start1", "end1", "truncated", F.col("first").alias("first_position"), "n_count", "ambiguous")


def q13_reverse_complement(spark, d: str) -> DataFrame:
    return P.sequences(spark, d).select("id", F.sha2(S.reverse_complement(F.col("seq")), 256).alias("sha256"))


def q14_composition(spark, d: str) -> DataFrame:
    return P.sequences(spark, d).select("id", F.length("seq").alias("length"), *[S.count_letters(F.col("seq"), x).alias(f"n_{x.lower()}") for x in "ACGTN"])


def _upstream500(spark, d: str) -> DataFrame:
    return _windows(spark, d, 500).select("id", "seq")


def _promoters(spark, d: str) -> DataFrame:
    """Windows of 500 with motifs put in: invented prose seldom has real promoters."""
    return spark.sql(P.promoters_sql("{w}"), w=_upstream500(spark, d).withColumnRenamed("seq", "w"))


def q15_motif_hits(spark, d: str) -> DataFrame:
    hits = S.motif_hits(F.col("seq"), -F.length("seq"), motifs.TATA, -120, -15, 4)
    return _upstream500(spark, d).select("id", F.explode(hits).alias("h")).select("id", F.col("h.start").alias("start"), F.col("h.mm").alias("mm"))


def q16_best_pairs(spark, d: str) -> DataFrame:
    return motifs.best_pair(_promoters(spark, d), motifs.GENERIC)


def q17_exact_motif(spark, d: str) -> DataFrame:
    return motifs.exact_hits(_upstream500(spark, d), motifs.MSP, -500, -1)


def q18_runs(spark, d: str) -> DataFrame:
    return P.sequences(spark, d).select("id", F.explode(S.runs(F.col("seq"), "T", 4)).alias("r")).select("id", F.col("r.start").alias("start"), F.col("r.end").alias("end"), F.col("r.open").alias("open"))


def q19_termination(spark, d: str) -> DataFrame:
    return motifs.termination(P.sequences(spark, d).select("id", "seq", F.greatest(F.lit(1), F.col("tss") - 40).alias("span")))


def q20_position_map(spark, d: str) -> DataFrame:
    """Position aligned to the 20th query letter, and to the middle one, of whole gapped texts."""
    q, s = F.translate("seq", "A", "-"), F.translate("seq", "C", "-")
    n = (F.length(F.translate(q, "-", "")) / 2).cast("int")
    return P.sequences(spark, d).select("id", S.position_map(q, s, F.lit(20)).alias("position"), S.position_map(q, s, n).alias("middle"))


def q21_ancestors(spark, d: str) -> DataFrame:
    return annotation.ancestors(P.edges(spark, d)).groupBy("id").agg(F.count("*").alias("n_ancestors"), F.min("ancestor").alias("first_ancestor"), F.max("ancestor").alias("last_ancestor"))


def q22_inherited(spark, d: str) -> DataFrame:
    own = P.table(spark, d, "SELECT concat('c', CAST(c_custkey AS STRING)) AS id, CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END AS value FROM customer", "customer")
    orders = P.table(spark, d, "SELECT concat('o', CAST(o_orderkey AS STRING)) AS id, CASE WHEN o_orderkey % 4 = 0 THEN o_orderstatus END AS value FROM orders", "orders")
    return annotation.inherited(own.unionByName(orders), annotation.ancestors(P.edges(spark, d)))


def q23_all_paths_self(spark, d: str) -> DataFrame:
    seeds = P.table(spark, d, "SELECT concat('n', CAST(n_nationkey AS STRING)) AS id FROM nation WHERE n_nationkey % 3 = 0", "nation")
    return annotation.all_paths_self(P.edges(spark, d), seeds)


def q24_context_counts(spark, d: str) -> DataFrame:
    return annotation.context_counts(P.hits(spark, d).where("query = 'family'").select(*PLACE), P.features(spark, d), P.KINDS)


def q25_orphans(spark, d: str) -> DataFrame:
    e = P.edges(spark, d)
    roots = P.table(spark, d, "SELECT concat('r', CAST(r_regionkey AS STRING)) AS id FROM region", "region")
    return annotation.orphans(e, e.select("id").union(roots).distinct())


def q26_strand_relation(spark, d: str) -> DataFrame:
    return annotation.relation_counts(P.hits(spark, d), P.features(spark, d))


def q27_review_union(spark, d: str) -> DataFrame:
    rest = L.loci(P.hits(spark, d)).where("not canonical").select("id", "seqid", "start1", "family_class").withColumn("evidence_set", F.lit("noncanonical_locus"))
    alone = intervals.unmatched(*_two(spark, d)).select("id", "seqid", "start1").withColumn("evidence_set", F.lit("standalone_competitor"))
    return rest.unionByName(alone, allowMissingColumns=True)


def q28_set_equality(spark, d: str) -> DataFrame:
    a, b = P.hits(spark, d).select("id", "start1"), P.hits(spark, d).where("tier <> 'weak'").select("id", "start1")
    return a.exceptAll(b).withColumn("side", F.lit("only_all")).unionByName(b.exceptAll(a).withColumn("side", F.lit("only_part"))).groupBy("side").agg(F.count("*").alias("n"))


def q29_exact_evidence(spark, d: str) -> DataFrame:
    place = ["seqid", "strand", "start1", "end1"]
    bodies = L.loci(P.hits(spark, d)).where("canonical").select("id", "seqid", "strand", F.col("body_start1").alias("start1"), F.col("body_end1").alias("end1"))
    evidence = P.hits(spark, d).where("tier in ('strong', 'moderate', 'none')").select(*place, F.col("id").alias("evidence_id"))
    return bodies.join(evidence, place, "left").groupBy("id").agg(F.array_join(F.array_sort(F.collect_list("evidence_id")), ",").alias("evidence"))


def q30_nested_windows(spark, d: str) -> DataFrame:
    sizes = (300, 500, 1000)
    w = P.sequences(spark, d).withColumn("tss", F.expr(f"CAST({BOUNDARY} AS INT)"))
    three = w.select("id", *[S.upstream(F.col("seq"), F.col("strand"), F.col("tss"), F.lit(k))["seq"].alias(f"w{k}") for k in sizes])
    return three.select("id", (F.endswith("w500", "w300") & F.endswith("w1000", "w500")).alias("nested"))


def _pairs(spark) -> list[tuple[int, int]]:
    """Pairs of the one model, bounded by its columns."""
    return [tuple(r) for r in integrity.bracket_pairs(spark.createDataFrame([("m", P.STRUCTURE)], "id string, structure string")).select("left", "right").orderBy("left").collect()]


def _metrics(spark, d: str) -> DataFrame:
    return integrity.alignment_metrics(P.table(spark, d, P.blocks_sql(True), "documents"), P.RF, _pairs(spark))


def q31_integrity(spark, d: str) -> DataFrame:
    return integrity.integrity(_metrics(spark, d)).select("id", "reasons", "status")


def _best_local(spark, d: str, loci: DataFrame) -> DataFrame:
    """The best local hit of each locus."""
    return support.best_searched(curation.windows(loci), lambda windows: P.local_search(windows, P.hits(spark, d)))


def q32_priority(spark, d: str) -> DataFrame:
    """Whole rows of loci. A locus takes the integrity of the first alignment of the document of its number; strong hits
    with the very place of a body are its activity evidence."""
    found = L.loci(P.hits(spark, d)).select("id", "seqid", "strand", "body_start1", "body_end1", "canonical", "multi_anchor_conflict", F.lit(P.TOTAL).alias("total"))
    loci = annotation.cut(L.numbered(annotation.cut(found)))
    best = _best_local(spark, d, loci)
    blocks = P.table(spark, d, P.blocks_sql(True), "documents").where("id like '%.0'")
    status = integrity.integrity(integrity.alignment_metrics(blocks, P.RF, _pairs(spark))).select(F.col("id").alias("_alignment"), "status")
    aligned = loci.select("id", F.concat((F.col("number") % 1000).cast("string"), F.lit(".0")).alias("_alignment")).join(status, "_alignment")
    place = ["seqid", "strand", "start1", "end1"]
    bodies = loci.select("id", "seqid", "strand", F.col("body_start1").alias("start1"), F.col("body_end1").alias("end1"))
    active = bodies.join(P.hits(spark, d).where("tier = 'strong'").select(*place), place)
    return curation.locus_rows(loci, best, P.features(spark, d), P.KINDS, aligned, active)


def q33_alignment_metrics(spark, d: str) -> DataFrame:
    return _metrics(spark, d).where("aligned is not null").drop("aligned", "seq", "pseudogene")


#: Letters of a seed word.
SEED = 7


def q34_kmer_seeds(spark, d: str) -> DataFrame:
    """Words of SEED bases that a benchmark item and a sequence share, by pair."""
    return seeds.shared_words(P.sequences(spark, d).select("id", "seq"), P.table(spark, d, P.sequences_sql(True, "benchmark", "item_id"), "benchmark").select(F.col("id").alias("item_id"), "seq"), SEED)


def q35_motif_scan(spark, d: str) -> DataFrame:
    return motifs.scan(_promoters(spark, d), motifs.LEGACY)


def q36_motif_scan_generic(spark, d: str) -> DataFrame:
    return motifs.scan(_promoters(spark, d), motifs.GENERIC)


def q37_related_windows(spark, d: str) -> DataFrame:
    seqs = P.sequences(spark, d)
    start, end = F.col("tss") - 60, F.col("tss") - 10
    w = S.related_windows(F.col("seq"), F.col("strand"), F.when(F.col("strand") == "+", start).otherwise(end), start, end)
    return seqs.select("id", F.inline(F.array(w))).select("id", F.md5("body").alias("body_md5"), F.md5("flanked").alias("flanked_md5"), "low", "high", "plus1", F.md5("context").alias("context_md5"), "span")


def q38_evidence_loci(spark, d: str) -> DataFrame:
    return L.evidence_loci(P.hits(spark, d))


def _context(spark, d: str):
    """Regions with their status, described features, and the regions' own ids."""
    features, regions = annotation.described(P.gff(spark, d)), P.table(spark, d, P.REGIONS, "orders")
    assessed = annotation.cut(annotation.audit_status(regions, P.gff(spark, d), P.table(spark, d, P.LENGTHS, "customer")))
    return assessed, features, annotation.cut(annotation.supporting_ids(regions, features))


def q39_self_ids(spark, d: str) -> DataFrame:
    return _context(spark, d)[2]


def q40_audit_status(spark, d: str) -> DataFrame:
    return annotation.audit_status(P.table(spark, d, P.REGIONS, "orders"), P.gff(spark, d), P.table(spark, d, P.LENGTHS, "customer")).select("id", "status", "reason")


def _own(spark, d: str):
    """Regions with their status, described features, the regions' own rows, and their trusted ids. Their own ids are declared by
    rows on the region's seqid, so that each resolves to itself."""
    assessed, features, ids = _context(spark, d)
    trusted = ids.withColumnRenamed("self_id", "feature_id")
    return assessed, features, annotation.self_features(features, trusted), trusted


def q41_audit_overlaps(spark, d: str) -> DataFrame:
    return annotation.audit_overlaps(*_own(spark, d)).drop("seqid")


def q42_audit_counts(spark, d: str) -> DataFrame:
    return annotation.audit_counts(*_own(spark, d)[:3])


def q43_resolve_ids(spark, d: str) -> DataFrame:
    wanted = P.gff(spark, d).select(F.concat(F.lit("w"), "n").alias("id"), "seqid", F.coalesce(F.element_at(F.try_element_at("attrs", F.lit("Name")), 1), "declared_id", F.lit("none")).alias("self_id"))
    return annotation.resolve_ids(wanted, annotation.without_containers(P.gff(spark, d))).select("id", "self_id", "resolved")


def q44_internal_checks(spark, d: str) -> DataFrame:
    loci = L.loci(P.hits(spark, d))
    c = F.col
    return integrity.all_true(
        loci, body_inside_envelope=(c("body_start1") >= c("envelope_start1")) & (c("body_end1") <= c("envelope_end1")), canonical_passes=~c("canonical") | c("family_ga"), strict_is_canonical=~c("strict") | c("canonical"),
        length_is_span=c("body_length") == c("body_end1") - c("body_start1") + 1, one_query_at_least=c("n_queries") > 0,
    )


def q45_boundaries(spark, d: str) -> DataFrame:
    """Boundary hypotheses of canonical loci, one row each: query position 1 where the best local hit is strong and has it aligned, and the body's edge."""
    loci = annotation.cut(L.loci(P.hits(spark, d)).where("canonical").select("id", "seqid", "strand", "body_start1", "body_end1", F.lit(P.TOTAL).alias("total")))
    return curation.hypotheses(curation.boundaries(loci, _best_local(spark, d, loci)))


def q46_known_cases(spark, d: str) -> DataFrame:
    cases = P.features(spark, d).where("kind = 'exon' and strand <> '.'").select(F.concat_ws(":", "seqid", "strand", "start1", "end1").alias("case_id"), "seqid", "strand", "start1", "end1").distinct()
    return intervals.known_cases(cases, P.hits(spark, d).where("tier = 'strong'"))


def q47_activity_geometry(spark, d: str) -> DataFrame:
    scanned = motifs.scan(_promoters(spark, d), motifs.GENERIC)
    return scanned.groupBy(integrity.activity_geometry(F.col("id") % 3 == 0, F.col("pair_class")).alias("interpretation")).agg(F.count("*").alias("n"))


def q48_declared_regions(spark, d: str) -> DataFrame:
    """By record: declared runs, positions that none covers, features outside all runs, and whether one covers it whole."""
    features, lengths, declared = P.gff(spark, d), P.table(spark, d, P.LENGTHS, "customer"), P.table(spark, d, P.DECLARED, "customer")
    return audits.declared_coverage(features, declared, lengths)


def q49_extended_hits(spark, d: str) -> DataFrame:
    """Hits of all benchmark items on all sequences, with their alignments."""
    items = P.table(spark, d, P.sequences_sql(True, "benchmark", "item_id"), "benchmark").select(F.col("id").alias("item_id"), "seq")
    return seeds.extended_hits(P.sequences(spark, d).select("id", "seq"), items)


def q50_metrics_by_model(spark, d: str) -> DataFrame:
    """Alignments of two models at once, whose columns and pairs are data."""
    models = spark.createDataFrame([(name, *lines) for name, lines in P.MODELS.items()], "model string, rf string, structure string")
    rows = P.table(spark, d, P.BY_MODEL.replace("{blocks}", P.blocks_sql(True)), "documents").where("aligned is not null")
    return integrity.metrics_by_model(rows, models).select("id", "model", "aligned_length", "rf_columns", "occupied", "gap5", "gap3", "interior_gaps", "longest_interior_gap", "inserted", "ambiguous", "paired_positions", "paired_observed", "paired_evaluable", "paired_compatible")


def queries() -> dict[str, Callable[..., DataFrame]]:
    return {name: f for name, f in globals().items() if name[0] == "q" and name[1:3].isdigit()}


def oracle_sql() -> dict[str, str]:
    return oracle.SQL

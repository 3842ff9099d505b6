"""Feature graphs and the features around an interval, keeping "none" (0) apart from "not annotated" (null)."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanforge.operators.intervals import overlap_counts, overlap_join


def cut(df: DataFrame) -> DataFrame:
    """df, written to the folder of ``spark.checkpoint.dir`` and read again, which cuts its lineage; a temporary folder
    only where that is unset (tests)."""
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = "file://" + tempfile.mkdtemp(prefix="spanforge-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: An ancestor of more ids than this has its values broadcast, as its ids would all meet in one task.
HOT = 100_000


def ancestors(edges: DataFrame) -> DataFrame:
    """id, ancestor of all pairs that a path of (id, parent) rows joins, the id itself left out; cycles end.

    Rows of ids that are nobody's parent are set aside, as long as that halves the rest, and meet what is found of their
    parents in one join each, at the end. On the rest paths double in length each round, so a chain of n rows takes
    log n joins."""
    rest, layers = cut(edges.where("parent is not null and id <> parent").select("id", F.col("parent").alias("ancestor")).distinct()), []
    size = rest.count()
    while size:
        marked = cut(rest.join(rest.select(F.col("ancestor").alias("id")).distinct().withColumn("_in", F.lit(True)), "id", "left"))
        inner = marked.where("_in is not null")
        if 2 * (now := inner.count()) > size:
            break
        layers.append(marked.where("_in is null").drop("_in"))
        rest, size = inner.drop("_in"), now
    further = lambda rows, known: rows.join(known.select(F.col("id").alias("ancestor"), F.col("ancestor").alias("next")), "ancestor").select("id", F.col("next").alias("ancestor"))
    known = rest
    while size:
        known = cut(known.union(further(known, known)).where("id <> ancestor").distinct())
        if (now := known.count()) == size:
            break
        size = now
    for rows in reversed(layers):
        known = cut(known.unionByName(rows.unionByName(further(rows, known)).distinct()))
    return known


def inherited(values: DataFrame, closure: DataFrame, hot: int = HOT) -> DataFrame:
    """id and value: own distinct values in order, else those of all ancestors; joined by commas. values: id, value (null:
    none). An ancestor of more than ``hot`` ids gives them its values by a broadcast."""
    joined = lambda df: df.groupBy("id").agg(F.array_join(F.array_sort(F.collect_set("value")), ",").alias("value"))
    some = values.where("value is not null")
    own = joined(some)
    given = some.select(F.col("id").alias("ancestor"), "value").distinct()
    often = cut(closure.groupBy("ancestor").agg(F.count("*").alias("_n")).where(F.col("_n") > hot).select("ancestor"))
    few = closure.join(F.broadcast(often), "ancestor", "left_anti").join(given, "ancestor")
    many = closure.join(F.broadcast(given.join(F.broadcast(often), "ancestor")), "ancestor")
    passed = joined(few.select("id", "value").unionByName(many.select("id", "value")))
    return values.select("id").distinct().join(own, "id", "left").join(passed.withColumnRenamed("value", "_passed"), "id", "left").select("id", F.coalesce("value", "_passed").alias("value"))


def all_paths_self(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """Ids that are seeds, or whose every (id, parent) row has a parent that is one of these ids: the least fixed point,
    so a cycle without a seed, an orphan and a child shared with a foreign parent all stay out."""
    own = cut(seeds.select("id").distinct())
    while True:
        marked = edges.join(own.select(F.col("id").alias("parent"), F.lit(1).alias("_in")), "parent", "left")
        whole = marked.groupBy("id").agg(F.min(F.coalesce("_in", F.lit(0))).alias("all")).where("all = 1").select("id")
        fresh = cut(whole.join(own, "id", "left_anti"))
        if fresh.isEmpty():
            return own
        own = cut(own.union(fresh))


def orphans(edges: DataFrame, known: DataFrame) -> DataFrame:
    """Parents that are no known id."""
    return edges.where("parent is not null").select("parent").distinct().join(known.select(F.col("id").alias("parent")), "parent", "left_anti")


def strand_relation(a: Column, b: Column) -> Column:
    signed = lambda x: x.isin("+", "-")
    return F.when(signed(a) & signed(b), F.when(a == b, "same").otherwise("opposite")).otherwise("unknown")


def _classes(kinds: dict[str, Column], strand: str = "strand") -> dict[str, Column]:
    """Conditions on features by kind and strand: what `_each` reads."""
    strands = {"+": F.col(strand) == "+", "-": F.col(strand) == "-", "all": F.lit(True)}
    return {f"{kind}|{name}": told & cond for kind, told in kinds.items() for name, cond in strands.items()}


def _region_counts(regions: DataFrame, features: DataFrame, kinds: dict[str, Column]) -> DataFrame:
    """id and the numbers of features that overlap the region, by `_classes`."""
    asked = regions.select("id", "seqid", F.col("start1").alias("r_start1"), F.col("end1").alias("r_end1"))
    return overlap_counts(features, asked, ["seqid"], ("start1", "end1", "r_start1", "r_end1"), _classes(kinds), ["id"], alone=True)


def _each(kinds: Iterable[str], n: Callable[[str, str], Column]) -> Column:
    """kind, n, n_same, n_opposite and n_unknown, a struct for each kind; n: the number of a kind under a name of `_classes`."""
    strand = F.coalesce(F.col("strand"), F.lit("."))
    signed = lambda kind, same: F.when(strand == "+", n(kind, "+" if same else "-")).when(strand == "-", n(kind, "-" if same else "+")).otherwise(0)
    return F.array(*[F.struct(F.lit(k).alias("kind"), n(k, "all").alias("n"), signed(k, True).alias("n_same"), signed(k, False).alias("n_opposite"), (n(k, "all") - signed(k, True) - signed(k, False)).alias("n_unknown")) for k in kinds])


def contexts(regions: DataFrame, features: DataFrame, kinds: list[str], key: str = "id") -> DataFrame:
    """regions with context: kind, n, n_same, n_opposite, n_unknown for each kind, the features that overlap the region by strand
    relation; null where the region's seqid has no feature of that kind at all. regions: ``key``, seqid, strand, start1, end1
    and others, which stay; features: seqid, strand, start1, end1, kind."""
    counts = _region_counts(regions.withColumn("id", F.col(key)), features, {kind: F.col("kind") == kind for kind in kinds}).withColumnRenamed("id", key)
    each = _each(kinds, lambda kind, name: F.coalesce(F.col(f"`{kind}|{name}`"), F.lit(0).cast("long")))
    available = F.broadcast(features.groupBy("seqid").agg(F.collect_set("kind").alias("_there")))
    shown = F.transform(each, lambda x: F.struct(x["kind"].alias("kind"), *[F.when(F.array_contains("_there", x["kind"]), x[c]).alias(c) for c in ("n", "n_same", "n_opposite", "n_unknown")]))
    return regions.join(counts, key, "left").join(available, "seqid", "left").select(*[regions[c] for c in regions.columns], shown.alias("context"))


def context_counts(regions: DataFrame, features: DataFrame, kinds: list[str]) -> DataFrame:
    """id, kind, n, n_same, n_opposite, n_unknown for every region and kind, of `contexts`."""
    return contexts(regions.select("id", "seqid", "strand", "start1", "end1"), features, kinds).select("id", F.inline("context"))


def relation_counts(regions: DataFrame, features: DataFrame) -> DataFrame:
    """kind, relation and n, the pairs of regions and features that overlap, by strand relation. Columns as in `context_counts`."""
    classes = {"plus": F.col("strand") == "+", "minus": F.col("strand") == "-", "every": F.lit(True)}
    f = features.select("seqid", "kind", *[F.col(c).alias(f"f_{c}") for c in ("strand", "start1", "end1")])
    counts = overlap_counts(regions, f, ["seqid"], ("start1", "end1", "f_start1", "f_end1"), classes, ["kind", "f_strand"])
    strand = F.coalesce(F.col("f_strand"), F.lit("."))
    same, opposite = F.when(strand == "+", F.col("plus")).when(strand == "-", F.col("minus")).otherwise(0), F.when(strand == "+", F.col("minus")).when(strand == "-", F.col("plus")).otherwise(0)
    each = F.array(*[F.struct(F.lit(name).alias("relation"), value.cast("long").alias("n")) for name, value in (("same", same), ("opposite", opposite), ("unknown", F.col("every") - same - opposite))])
    return counts.select("kind", F.inline(each)).groupBy("kind", "relation").agg(F.sum("n").alias("n")).where("n > 0")


#: Annotation categories, attributes that hold a biotype, and feature types by category.
CATEGORIES = ("gene_span", "transcript_span", "pseudogene", "exon", "CDS", "five_prime_UTR", "three_prime_UTR", "ncRNA", "repeat", "other")
BIOTYPE_KEYS = ("gene_biotype", "transcript_biotype", "biotype", "gene_type", "transcript_type", "ncRNA_class", "ncrna_class")
LABEL_KEYS = ("Name", "product", "description", "Note", "gene", "gene_name", "Dbxref", "ncRNA_class", "ncrna_class", "biotype")
ALIAS_KEYS = ("Alias", "Name", "gene_id", "transcript_id", "locus_tag")
CONTAINERS = ("region", "chromosome", "chromosome_arm", "contig", "supercontig", "scaffold")
RNA_TYPES = (
    "ncrna", "lncrna", "lnc_rna", "lnc_rna_transcript", "lincrna", "snrna", "snorna", "scrna", "rrna", "trna", "mirna", "pre_mirna", "srna", "antisense_rna", "guide_rna",
    "rnase_p_rna", "rnase_mrp_rna", "ribozyme", "telomerase_rna", "srp_rna", "u6_snrna", "u6atac_snrna",
)
TRANSCRIPTS = ("mrna", "transcript", "primary_transcript", "pseudogenic_transcript")
UTR5, UTR3 = ("five_prime_utr", "5_prime_utr", "5utr", "5_utr"), ("three_prime_utr", "3_prime_utr", "3utr", "3_utr")
REPEATS = (
    "repeat", "repeat_region", "repeat_fragment", "transposable_element", "transposable_element_gene", "retrotransposon", "dna_transposon", "ltr_retrotransposon", "ltr",
    "long_terminal_repeat", "tandem_repeat", "satellite_dna", "dispersed_repeat", "inverted_repeat", "mobile_element",
)
REJECTED, ACCEPTED = r"(?i)u6[ _-]?atac|RF00619", r"(?i)(?<![A-Za-z0-9])(?:[A-Za-z]{1,4})?U6(?![A-Za-z])|RF00026"
#: Feature tables have n (a row's number), seqid, kind, start1, end1, strand, declared_id (null: none), parents
#: (array<string>) and attrs (map<string, array<string>>): those of `readers.read_gff3`, with its line_number as n.



def _values(keys: tuple[str, ...]) -> Column:
    """Values of the first row's attributes under any of these keys, in key order."""
    return F.flatten(F.array(*[F.coalesce(F.try_element_at("attrs", F.lit(k)), F.array().cast("array<string>")) for k in keys]))


def is_gene(kind: Column) -> Column:
    return F.lower(kind).isin("gene", "pseudogene") | F.lower(kind).endswith("_gene")


def is_rna(kind: Column) -> Column:
    return F.lower(kind).isin(*RNA_TYPES) | F.lower(kind).endswith("_rna")


def own_biotypes() -> Column:
    """Distinct biotypes of a feature's attributes in order; where there are none, an RNA type stands for itself."""
    own = F.array_sort(F.array_distinct(_values(BIOTYPE_KEYS)))
    return F.when(F.size(own) > 0, own).when(F.lower("kind").isin(*RNA_TYPES), F.array("kind")).otherwise(F.array().cast("array<string>"))


def categories(kind: Column, biotypes: Column, attrs: Column) -> Column:
    """Sorted categories of a feature, which do not exclude each other; 'other' where none fits."""
    k = F.lower(kind)
    any_ = lambda cond: F.exists(biotypes, lambda b: cond(F.replace(F.lower(b), F.lit("-"), F.lit("_"))))
    pseudo = k.contains("pseudogene") | k.contains("pseudogenic") | any_(lambda b: b.contains("pseudogene")) | F.coalesce(F.exists(F.try_element_at(attrs, F.lit("pseudo")), lambda v: F.lower(v) == "true"), F.lit(False))
    tests = {
        "gene_span": is_gene(kind), "transcript_span": k.isin(*TRANSCRIPTS) | is_rna(kind), "pseudogene": pseudo, "exon": k.isin("exon", "pseudogenic_exon"), "CDS": k == "cds", "five_prime_UTR": k.isin(*UTR5), "three_prime_UTR": k.isin(*UTR3),
        "ncRNA": is_rna(kind) | any_(lambda b: b.isin(*RNA_TYPES) | b.contains("noncoding") | b.contains("non_coding")), "repeat": k.isin(*REPEATS) | k.contains("transposon") | k.contains("repeat"),
    }
    found = F.filter(F.array(*[F.when(cond, name) for name, cond in tests.items()]), lambda x: x.isNotNull())
    return F.array_sort(F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("other"))))


def without_containers(features: DataFrame) -> DataFrame:
    """features but for rows that only describe whole sequences, which would overlap everything."""
    return features.where(~F.lower("kind").isin(*CONTAINERS))


def feature_edges(features: DataFrame) -> DataFrame:
    """id, parent of each row with a declared id; a row without parents has a null one."""
    return features.where("declared_id is not null").select(F.col("declared_id").alias("id"), F.explode_outer("parents").alias("parent"))


def lineage(features: DataFrame, closure: DataFrame) -> DataFrame:
    """n, ancestor: the parents of each row, and theirs, without the row's own id. closure: `ancestors` of the edges."""
    direct = features.select("n", "declared_id", F.explode("parents").alias("ancestor"))
    further = direct.join(closure.select(F.col("id").alias("ancestor"), F.col("ancestor").alias("next")), "ancestor").select("n", "declared_id", F.col("next").alias("ancestor"))
    return direct.unionByName(further).where(~F.col("ancestor").eqNullSafe(F.col("declared_id"))).select("n", "ancestor").distinct()


def described(features: DataFrame) -> DataFrame:
    """features (without containers) with biotypes (own, else all of the lineage's), categories by these, own_categories,
    gene_ids (itself or ancestors that are genes), ancestors, and missing (ancestors that no row declares)."""
    rows = cut(without_containers(features).withColumn("own", own_biotypes()))
    closure = ancestors(feature_edges(rows))
    lines = cut(lineage(rows, closure))
    of = rows.where("declared_id is not null").select(F.col("declared_id").alias("ancestor"), F.col("own").alias("a_own"), is_gene(F.col("kind")).alias("a_gene"))
    known = lines.join(of, "ancestor", "left")
    gathered = known.groupBy("n").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("a_own")))).alias("passed"), F.array_sort(F.collect_set(F.when(F.col("a_gene"), F.col("ancestor")))).alias("genes"),
        F.array_sort(F.collect_set("ancestor")).alias("ancestors"), F.array_sort(F.collect_set(F.when(F.col("a_gene").isNull(), F.col("ancestor")))).alias("missing"),
    )
    none = F.array().cast("array<string>")
    full = rows.join(gathered, "n", "left").withColumns({c: F.coalesce(c, none) for c in ("passed", "genes", "ancestors", "missing")})
    own_gene = F.when(is_gene(F.col("kind")) & F.col("declared_id").isNotNull(), F.array("declared_id")).otherwise(none)
    full = full.withColumns({"biotypes": F.when(F.size("own") > 0, F.col("own")).otherwise(F.col("passed")), "gene_ids": F.array_sort(F.array_union("genes", own_gene))})
    return cut(full.withColumns({"categories": categories(F.col("kind"), F.col("biotypes"), F.col("attrs")), "own_categories": categories(F.col("kind"), F.col("own"), F.col("attrs"))}).drop("passed", "genes"))


def resolve_ids(wanted: DataFrame, features: DataFrame) -> DataFrame:
    """wanted (id, seqid, self_id) with resolved: the declared id that self_id is, else the one it is an alias of, if
    exactly one of them has a row on the seqid; else null."""
    rows = features.where("declared_id is not null")
    alias = rows.select(F.explode(F.array_distinct(_values(ALIAS_KEYS))).alias("self_id"), F.col("declared_id").alias("candidate")).distinct()
    declared = rows.select(F.col("declared_id").alias("self_id"), F.col("declared_id").alias("candidate")).distinct()
    both = declared.withColumn("p", F.lit(0)).unionByName(alias.join(declared.select("self_id"), "self_id", "left_anti").withColumn("p", F.lit(1)))
    there = rows.select(F.col("declared_id").alias("candidate"), "seqid").distinct()
    # By name and seqid, before any row that wants them: a name of very many features has one row a seqid.
    found = both.select("self_id", "candidate").join(there, "candidate").groupBy("self_id", "seqid").agg(F.min("candidate").alias("resolved"), F.max("candidate").alias("_last"))
    return wanted.join(found.where("resolved = _last").drop("_last"), ["seqid", "self_id"], "left").select(*wanted.columns, "resolved")


def supporting_ids(regions: DataFrame, features: DataFrame) -> DataFrame:
    """id, self_id: features that are a region's own by their labels. An RNA on the region's strand that overlaps it is,
    if the labels of its row and its lineage accept it and none rejects it; a gene of its lineage at the same place is, if
    it is not protein coding and all of its children are. features: of `described`.

    What labels say is of a feature alone, so features are judged before they meet any region."""
    rna = features.where(is_rna(F.col("kind")) & F.col("declared_id").isNotNull() & F.col("strand").isin("+", "-"))
    key = ["n", "declared_id", "seqid", "strand", "f_start1", "f_end1"]
    f = rna.select("n", "declared_id", "seqid", "strand", F.col("start1").alias("f_start1"), F.col("end1").alias("f_end1"), "kind", "ancestors", _values(LABEL_KEYS).alias("labels"))
    coding = features.where(F.exists("own", lambda b: F.lower(b) == "protein_coding")).select(F.col("declared_id").alias("ancestor")).distinct().withColumn("a_coding", F.lit(True))
    rows = features.where("declared_id is not null").select(F.col("declared_id").alias("ancestor"), F.col("seqid").alias("a_seqid"), F.col("strand").alias("a_strand"), F.col("start1").alias("a_start1"), F.col("end1").alias("a_end1"), is_gene(F.col("kind")).alias("a_gene"), _values(LABEL_KEYS).alias("a_labels"))
    up = f.select(*key, F.explode("ancestors").alias("ancestor")).join(rows, "ancestor").join(coding, "ancestor", "left")
    gene = F.expr("a_gene and a_coding is null and a_seqid = seqid and a_strand = strand and a_start1 = f_start1 and a_end1 = f_end1")
    passed = up.groupBy(*key).agg(F.flatten(F.collect_list("a_labels")).alias("passed"), F.collect_set(F.when(gene, F.col("ancestor"))).alias("genes"))
    none = F.array().cast("array<string>")
    text = F.array_join(F.concat("labels", F.coalesce("passed", none)), " ")
    judged = f.join(passed, key, "left").withColumns({"text": text, "genes": F.coalesce("genes", none)})
    accepted = cut(judged.where(~F.col("text").rlike(REJECTED) & ((F.lower("kind") == "u6_snrna") | F.col("text").rlike(ACCEPTED))).select(*key, "genes"))
    own = cut(overlap_join(regions, accepted, ["seqid", "strand"], ("start1", "end1", "f_start1", "f_end1")).select("id", "declared_id", "genes"))
    same = own.select("id", F.explode("genes").alias("parent")).distinct()
    children = features.select("declared_id", F.explode("parents").alias("parent"))
    in_ = own.select("id", "declared_id").distinct().withColumn("_in", F.lit(1))
    all_in = same.join(children, "parent").join(in_, ["id", "declared_id"], "left").groupBy("id", "parent").agg(F.min(F.coalesce("_in", F.lit(0))).alias("all"))
    return own.select("id", F.col("declared_id").alias("self_id")).unionByName(all_in.where("all = 1").select("id", F.col("parent").alias("self_id"))).distinct()


def self_features(features: DataFrame, resolved: DataFrame) -> DataFrame:
    """id, n: rows that are a region's own. resolved: id, feature_id (its trusted ids, each once; read again and again, so written
    before). An id is its own too if each of its rows has parents and all of them are: the least fixed point, by region; a row
    without an id is by its parents."""
    edges = feature_edges(features)
    own = resolved.select("id", "feature_id")
    whole = lambda rows, key: rows.groupBy("id", key).agg(F.min("_in").alias("all")).where("all = 1").select("id", key)
    marked = lambda rows, own: rows.join(own.select("id", F.col("feature_id").alias("parent"), F.lit(1).alias("_m")), ["id", "parent"], "left").withColumn("_in", F.coalesce("_m", F.lit(0)))
    while True:
        children = own.join(edges.select(F.col("parent").alias("feature_id"), F.col("id").alias("child")), "feature_id").select("id", F.col("child").alias("feature_id")).distinct().join(own, ["id", "feature_id"], "left_anti")
        rows = children.join(edges.select(F.col("id").alias("feature_id"), "parent"), "feature_id")
        fresh = cut(whole(marked(rows, own), "feature_id"))
        if fresh.isEmpty():
            break
        own = cut(own.unionByName(fresh))
    declared = own.join(features.select(F.col("declared_id").alias("feature_id"), "n"), "feature_id").select("id", "n")
    bare = features.where("declared_id is null").select("n", F.explode("parents").alias("parent"))
    near = own.join(bare.select("n", F.col("parent").alias("feature_id")), "feature_id").select("id", "n").distinct().join(bare, "n")
    return declared.unionByName(whole(marked(near, own), "n"))


def audit_status(regions: DataFrame, features: DataFrame | None, lengths: DataFrame | None = None) -> DataFrame:
    """regions with status and reason: context_not_assessed for want of features, of the seqid (among features, or among
    lengths), because features of the seqid pass its end, or for a region that is none; else assessed."""
    if features is None:
        return regions.withColumns({"status": F.lit("context_not_assessed"), "reason": F.lit("no_gff")})
    rows = without_containers(features)
    empty = F.lit(rows.isEmpty())
    ends = rows.groupBy("seqid").agg(F.max("end1").alias("_last"))
    out = regions.join(ends, "seqid", "left")
    out = out.withColumn("_length", F.lit(None).cast("int")) if lengths is None else out.join(lengths.select("seqid", F.col("length").alias("_length")), "seqid", "left")
    no_seqid = F.col("_last").isNull() | (F.lit(lengths is not None) & F.col("_length").isNull())
    bad = F.col("start1").isNull() | F.col("end1").isNull() | (F.col("start1") < 1) | (F.col("end1") < F.col("start1")) | ~F.coalesce(F.col("strand"), F.lit("")).isin("+", "-", ".", "?") | F.coalesce(F.col("end1") > F.col("_length"), F.lit(False))
    reason = F.when(empty, "empty_gff").when(no_seqid, "seqid_mismatch").when(F.col("_last") > F.col("_length"), "gff_coordinates_out_of_bounds").when(bad, "invalid_region")
    return out.withColumn("reason", reason).withColumn("status", F.when(F.col("reason").isNull(), "assessed").otherwise("context_not_assessed")).drop("_last", "_length")


def audit_overlaps(assessed: DataFrame, features: DataFrame, own: DataFrame, resolved: DataFrame) -> DataFrame:
    """id and each feature row that overlaps its region: overlap, fraction, relation, categories, gene_ids, biotype,
    missing parents, is_self (left out of counts) and shared_with_self. features: of `described`; own: `self_features`;
    resolved: id, feature_id.

    A region takes its own rows and ids with it, so that pairs, which are many, are not shuffled again once they have met."""
    joined = lambda c: F.array_join(c, "|")
    f = features.select(
        "n", "seqid", F.col("kind").alias("feature_type"), F.coalesce("declared_id", F.concat(F.lit("line:"), F.col("n").cast("string"))).alias("feature_id"), F.col("strand").alias("f_strand"), F.col("start1").alias("f_start1"), F.col("end1").alias("f_end1"),
        joined("categories").alias("categories"), joined("gene_ids").alias("gene_ids"), joined("biotypes").alias("biotype"), joined("missing").alias("missing_parents"), "ancestors",
    )
    rows, ids = own.groupBy("id").agg(F.collect_set("n").alias("_mine")), resolved.groupBy("id").agg(F.collect_set("feature_id").alias("_self"))
    regions = cut(assessed.where("status = 'assessed'").select("id", "seqid", "strand", "start1", "end1").join(rows, "id", "left").join(ids, "id", "left"))
    met = overlap_join(regions, f, ["seqid"], ("start1", "end1", "f_start1", "f_end1"))
    same = F.least("end1", "f_end1") - F.greatest("start1", "f_start1") + 1
    return met.select(
        "id", "n", "seqid", "feature_type", "feature_id", "f_start1", "f_end1", same.alias("overlap"), (same / (F.col("end1") - F.col("start1") + 1)).alias("fraction"), strand_relation(F.col("strand"), F.col("f_strand")).alias("relation"), "categories",
        "gene_ids", "biotype", "missing_parents", F.coalesce(F.array_contains("_mine", F.col("n")), F.lit(False)).alias("is_self"), F.coalesce(F.arrays_overlap("ancestors", "_self"), F.lit(False)).alias("shared_with_self"),
    )


def audit_counts(assessed: DataFrame, features: DataFrame, own: DataFrame) -> DataFrame:
    """id, kind (one of CATEGORIES), n, n_same, n_opposite, n_unknown: null where the seqid shows no feature of the kind
    by its own biotypes and the region meets none; a feature counts once in each of its categories, and a region's own rows
    do not. features: of `described`; own: `self_features`.

    All that overlap a region are counted without making pairs, and its own rows among them are taken off."""
    kinds = {kind: F.array_contains("categories", kind) for kind in CATEGORIES}
    place = {c: F.when(F.col("status") == "assessed", F.col(c)) for c in ("start1", "end1")}
    regions = assessed.select("id", "seqid", "strand", "status", *[x.alias(c) for c, x in place.items()])
    f = features.select("n", "seqid", F.col("strand").alias("f_strand"), F.col("start1").alias("f_start1"), F.col("end1").alias("f_end1"), "categories")
    mine = own.select("id", "n").repartition("n").distinct().join(f, "n").join(regions.select("id", "seqid", "start1", "end1"), ["id", "seqid"]).where("start1 <= f_end1 and f_start1 <= end1")
    taken = mine.groupBy("id").agg(*[F.count_if(cond).alias(f"own|{name}") for name, cond in _classes(kinds, "f_strand").items()])
    counts = _region_counts(regions, features.select("seqid", "strand", "start1", "end1", "categories"), kinds)
    some = lambda name: F.coalesce(F.col(f"`{name}`"), F.lit(0).cast("long"))
    each = _each(CATEGORIES, lambda kind, name: some(f"{kind}|{name}") - some(f"own|{kind}|{name}"))
    grid = regions.join(counts, "id", "left").join(taken, "id", "left").select("id", "seqid", "status", F.inline(each))
    there = features.select("seqid", F.explode("own_categories").alias("kind")).distinct().withColumn("_there", F.lit(True))
    known = (F.col("status") == "assessed") & (F.col("_there") | (F.col("n") > 0))
    return grid.join(there, ["seqid", "kind"], "left").select("id", "kind", *[F.when(known, F.col(c)).alias(c) for c in ("n", "n_same", "n_opposite", "n_unknown")])

"""The test tables seen as hits, features, sequences and graphs. The SQL runs in Spark and in DuckDB alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanforge.operators.intervals import overlap_join

#: Places are dealt over 25 sequences of two million positions.
HITS = """SELECT concat(CAST(l_orderkey AS STRING), '.', CAST(l_linenumber AS STRING), '.', CAST(l_partkey AS STRING), '.', CAST(l_suppkey AS STRING), '.', CAST(CAST(l_quantity AS INT) AS STRING)) AS id,
  concat('c', CAST(l_suppkey % 25 AS STRING)) AS seqid, CASE WHEN l_linenumber % 2 = 0 THEN '+' ELSE '-' END AS strand,
  CASE WHEN l_returnflag = 'A' THEN 'cmsearch' ELSE 'blastn' END AS method,
  CASE WHEN l_returnflag <> 'A' THEN l_returnflag WHEN l_partkey % 3 = 0 THEN 'other' ELSE 'family' END AS query,
  CAST((l_partkey * 9973 + l_orderkey * 31) % 2000000 + 1 AS INT) AS start1, CAST((l_partkey * 9973 + l_orderkey * 31) % 2000000 + 60 + l_quantity AS INT) AS end1,
  60 + l_tax * 500 AS pident, 2 * l_quantity AS qcov, CASE WHEN l_returnflag <> 'A' THEN l_extendedprice / 300 END AS bits,
  CASE WHEN l_returnflag = 'A' THEN l_extendedprice / 1000 END AS score, CASE WHEN l_returnflag = 'A' THEN l_extendedprice >= 30000 END AS ga_pass,
  CASE WHEN l_returnflag <> 'A' THEN CAST(1 + l_orderkey % 3 AS INT) END AS qstart, CASE WHEN l_returnflag <> 'A' THEN CAST(l_suppkey % 2 AS INT) END AS gapopen, 2000105 AS subject_length,
  CASE WHEN l_returnflag = 'A' THEN CASE WHEN l_orderkey % 4 = 0 THEN '5' ELSE 'no' END END AS trunc, l_tax / 1000 AS evalue FROM lineitem"""
TIERED = f"""SELECT *, CASE WHEN method <> 'blastn' THEN 'none' WHEN pident >= 80 AND qcov >= 80 AND bits >= 80 THEN 'strong'
  WHEN pident >= 70 AND qcov >= 60 AND bits >= 50 THEN 'moderate' ELSE 'weak' END AS tier FROM ({HITS})"""
FEATURES = """SELECT concat('c', CAST(o_custkey % 25 AS STRING)) AS seqid, CASE o_orderkey % 3 WHEN 0 THEN '+' WHEN 1 THEN '-' ELSE '.' END AS strand,
  CAST((o_orderkey * 7919 + o_custkey * 17) % 2000000 + 1 AS INT) AS start1, CAST((o_orderkey * 7919 + o_custkey * 17) % 2000000 + 200 + o_custkey % 900 AS INT) AS end1,
  CASE WHEN o_custkey % 25 = 7 AND o_orderstatus = 'F' THEN 'repeat' WHEN o_orderstatus = 'F' THEN 'exon' WHEN o_orderstatus = 'O' THEN 'CDS' ELSE 'UTR' END AS kind FROM orders"""
KINDS = ["CDS", "UTR", "exon", "repeat"]
#: Letters of texts as bases; case is raised after other characters are gone, so that none of them becomes a letter.
_MAPPED = "translate(upper(regexp_replace(coalesce(text, ''), '[^A-Za-z]', ''{g})), 'BDEFHIJKLMNOPQRSUVWXYZ', 'ACGTACGTACNGTACGTACGTA')"
_SEQUENCE = "doc_id AS id, {seq} AS seq, CASE WHEN doc_id % 2 = 0 THEN '+' ELSE '-' END AS strand, CAST(length({seq}) - length({seq}) % 7 AS INT) AS tss"
EDGES = """SELECT concat('n', CAST(n_nationkey AS STRING)) AS id, concat('r', CAST(n_regionkey AS STRING)) AS parent FROM nation
  UNION ALL SELECT concat('c', CAST(c_custkey AS STRING)), concat('n', CAST(c_nationkey AS STRING)) FROM customer
  UNION ALL SELECT concat('o', CAST(o_orderkey AS STRING)), concat('c', CAST(o_custkey AS STRING)) FROM orders
  UNION ALL SELECT concat('o', CAST(o_orderkey AS STRING)), concat('c', CAST(o_custkey + 1 AS STRING)) FROM orders WHERE o_orderkey % 5 = 0"""


#: Length of each sequence of the hits.
TOTAL = 2_000_105
#: Declared parts of the features' sequences: some apart, some that touch or overlap, one whole.
DECLARED = """SELECT seqid, start1, CASE WHEN seqid = 'c7' THEN least(end1, 1000000) ELSE end1 END AS end1 FROM (SELECT concat('c', CAST(c_custkey % 25 AS STRING)) AS seqid,
  CAST(CASE WHEN c_custkey % 25 = 3 THEN 1 ELSE (c_custkey * 7919) % 900000 + 1 END AS INT) AS start1, CAST(CASE WHEN c_custkey % 25 = 3 THEN 2100000 ELSE (c_custkey * 7919) % 900000 + 2000 + (c_custkey % 11) * 3000 END AS INT) AS end1 FROM customer)"""

#: Genes of customers and what is in them, of orders: some containers, orphans, shared children and rows without an id.
_GENE = "(c * 7919) % 2000000 + 1"
GFF = f"""SELECT CAST(c AS BIGINT) AS n, concat('c', CAST(c % 25 AS STRING)) AS seqid, CASE c % 8 WHEN 0 THEN 'pseudogene' WHEN 1 THEN 'repeat_region' WHEN 2 THEN 'chromosome' ELSE 'gene' END AS kind, CAST({_GENE} AS INT) AS start1, CAST({_GENE} + 899 AS INT) AS end1,
  CASE c % 3 WHEN 0 THEN '+' WHEN 1 THEN '-' ELSE '.' END AS strand, concat('c', CAST(c AS STRING)) AS declared_id, CASE WHEN c % 10 = 5 THEN 'n99' END AS parent1, CAST(NULL AS STRING) AS parent2, CASE c % 5 WHEN 0 THEN 'snRNA' WHEN 1 THEN 'protein_coding' WHEN 2 THEN 'processed-pseudogene' END AS biotype,
  CASE c % 6 WHEN 0 THEN 'OsU6-1' WHEN 1 THEN 'U6 atac like' ELSE concat('gene ', CAST(c % 4 AS STRING)) END AS name FROM (SELECT c_custkey AS c FROM customer)
  UNION ALL SELECT CAST(1000000 + o AS BIGINT), concat('c', CAST(c % 25 AS STRING)), CASE o % 7 WHEN 0 THEN 'snRNA' WHEN 1 THEN 'mRNA' WHEN 2 THEN 'exon' WHEN 3 THEN 'CDS' WHEN 4 THEN 'U6_snRNA' WHEN 5 THEN 'five_prime_UTR' ELSE 'ncRNA' END, CAST({_GENE} + (o % 3) * 100 AS INT), CAST({_GENE} + CASE WHEN o % 3 = 0 THEN 899 ELSE (o % 3) * 100 + 150 END AS INT),
  CASE c % 3 WHEN 0 THEN '+' WHEN 1 THEN '-' ELSE '.' END, CASE WHEN o % 9 > 0 THEN concat('o', CAST(o AS STRING)) END, concat('c', CAST(c AS STRING)), CASE WHEN o % 5 = 0 THEN concat('c', CAST(c + 1 AS STRING)) END, CAST(NULL AS STRING), CASE o % 4 WHEN 0 THEN 'AtU6.1' WHEN 1 THEN 'RNA' END FROM (SELECT o_orderkey AS o, o_custkey AS c FROM orders)"""
REGIONS = f"""SELECT concat('r', CAST(o AS STRING)) AS id, CASE WHEN o % 31 = 0 THEN 'zz' ELSE concat('c', CAST(c % 25 AS STRING)) END AS seqid, CASE o % 2 WHEN 0 THEN '+' ELSE '-' END AS strand, CAST({_GENE} + o % 400 AS INT) AS start1, CAST({_GENE} + o % 400 + CASE WHEN o % 37 = 0 THEN -5 ELSE 99 END AS INT) AS end1
  FROM (SELECT o_orderkey AS o, o_custkey AS c FROM orders WHERE o_orderkey % 3 = 1)"""
LENGTHS = "SELECT concat('c', CAST(k AS STRING)) AS seqid, CASE WHEN k = 7 THEN 1000000 ELSE 2100000 END AS length FROM (SELECT DISTINCT c_custkey % 25 AS k FROM customer)"


def sequences_sql(spark: bool, source: str = "documents", key: str = "doc_id") -> str:
    """id, seq, strand and tss of each text. In Spark the letters are bound by a generator, so that they are mapped once
    a row, however often a query uses them."""
    mapped, row = _MAPPED.replace("{g}", "" if spark else ", 'g'"), _SEQUENCE.replace("doc_id", key)
    if spark:
        parts = f"'id', {key}, 'seq', s, 'strand', CASE WHEN {key} % 2 = 0 THEN '+' ELSE '-' END, 'tss', CAST(length(s) - length(s) % 7 AS INT)"
        return f"SELECT inline(transform(array({mapped}), s -> named_struct({parts}))) FROM {source}"
    return f"SELECT {row.replace('{seq}', 's')} FROM (SELECT {key}, {mapped} AS s FROM {source})"


#: A model of 110 columns: inserts at every eleventh, and pairs in three stems, one of them a knot.
RF = "".join("." if k % 11 == 0 else "x" for k in range(1, 111))
STRUCTURE = "<" * 8 + "." * 4 + ">" * 8 + "." * 5 + "((((((.AAAA..))))))" + "." * 7 + "aaaa" + "." * 55

#: Models by name, with their reference line and structure: the one above, and one with other inserts and no structure.
MODELS = {"m1": (RF, STRUCTURE), "m2": ("".join("~" if k % 7 == 0 else "x" for k in range(1, 111)), None)}
BY_MODEL = "SELECT id, aligned, CASE WHEN CAST(split_part(id, '.', 2) AS INT) % 2 = 0 THEN 'm1' ELSE 'm2' END AS model FROM ({blocks})"


def blocks_sql(spark: bool) -> str:
    """All of every sequence in consecutive rows of 110 columns (block, from 0), with gaps put in by rule, and the body that
    was aligned: the row's letters, or others where the alignment is to be refused."""
    # The text is cut once: a substring at a place walks there from the text's start.
    cut = "posexplode(regexp_extract_all(seq, '.{{1,110}}', 0)) AS (block, piece)" if spark else "unnest(range(len(pieces))) AS block, unnest(pieces) AS piece"
    source = sequences_sql(spark) if spark else f"SELECT id, regexp_extract_all(seq, '.{{1,110}}') AS pieces FROM ({sequences_sql(spark)})"
    rows = f"SELECT id, block, rpad(piece, 110, '-') AS raw FROM (SELECT id, {cut} FROM ({source}))"
    inner = "CASE block % 4 WHEN 0 THEN translate(raw, 'N', 'A') WHEN 1 THEN translate(raw, 'N', '-') WHEN 2 THEN concat(translate(substr(raw, 1, 50), 'N', 'G'), '~.', translate(substr(raw, 53), 'N', 'C')) ELSE raw END"
    gapped = f"SELECT id, block, concat(repeat('-', cut), substr({inner}, cut + 1)) AS aligned FROM (SELECT *, CAST((id + block) % 9 AS INT) AS cut FROM ({rows}))"
    bare = f"SELECT *, translate(aligned, '.-_~', '') AS bare FROM ({gapped})"
    return f"""SELECT concat(CAST(id AS STRING), '.', CAST(block AS STRING)) AS id, CASE WHEN (id + block) % 23 = 0 THEN NULL ELSE aligned END AS aligned,
  CASE WHEN (id + block) % 17 = 0 THEN concat(bare, 'A') WHEN (id + block) % 19 = 0 THEN reverse(bare) ELSE bare END AS seq, (id + block) % 29 = 0 AS pseudogene FROM ({bare})"""


def promoters_sql(windows: str) -> str:
    """windows (id, w) with motifs put in at places and with faults that change with the id, where there is room."""
    first = "CASE id % 4 WHEN 0 THEN 'GTACCACATCG' WHEN 1 THEN 'ATCCCACATCT' ELSE 'ATACCACTTNG' END"
    second = "CASE id % 3 WHEN 0 THEN 'TTTATATA' WHEN 1 THEN 'TTTAAATA' ELSE 'TATATACA' END"
    a, b = "(66 - id % 5)", "(30 + id % 3)"
    return f"""SELECT id, CASE WHEN length(w) < 90 OR id % 7 = 0 THEN w ELSE concat(substr(w, 1, CAST(length(w) - {a} AS INT)), {first}, substr(w, CAST(length(w) - {a} + 12 AS INT), CAST({a} - 11 - {b} AS INT)), {second}, substr(w, CAST(length(w) - {b} + 9 AS INT))) END AS seq FROM {windows}"""


def table(spark: SparkSession, sf_dir: str, sql: str, *names: str) -> DataFrame:
    """The rows of a projection over the tables named."""
    return spark.sql(sql if not names else _views(sql, names), **{n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names})


def _views(sql: str, names: tuple[str, ...]) -> str:
    for name in names:
        sql = sql.replace(f"FROM {name}", f"FROM {{{name}}}")
    return sql


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, TIERED, "lineitem")


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, FEATURES, "orders")


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, sequences_sql(True), "documents")


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, EDGES, "nation", "customer", "orders")


def gff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The features as `readers.read_gff3` gives them."""
    rows = table(spark, sf_dir, GFF, "customer", "orders")
    entry = lambda key, c: F.when(F.col(c).isNotNull(), F.struct(F.lit(key).alias("k"), F.array(c).alias("v")))
    attrs = F.map_from_entries(F.filter(F.array(entry("gene_biotype", "biotype"), entry("Name", "name")), lambda x: x.isNotNull()))
    parents = F.filter(F.array("parent1", "parent2"), lambda x: x.isNotNull())
    return rows.select("n", "seqid", "kind", "start1", "end1", "strand", "declared_id", parents.alias("parents"), attrs.alias("attrs"))


def local_search(windows: DataFrame, hits: DataFrame) -> DataFrame:
    """Hits of query N as a search of the windows (id, seqid, strand, start1, end1 of the body, low, high) would report them: in
    the window's own direction, cut at its ends, with the window's columns but seqid. position: where query position 1 is, if it
    is aligned."""
    found = hits.where("method = 'blastn' and query = 'N'").select("seqid", "strand", F.col("start1").alias("_s"), F.col("end1").alias("_e"), F.col("id").alias("ordinal"), "qstart", "qcov", "bits", (F.col("tier") == "strong").alias("strong"))
    met = overlap_join(windows, found, ["seqid", "strand"], ("low", "high", "_s", "_e"))
    plus = F.col("strand") == "+"
    lost = F.greatest(F.lit(0), F.when(plus, F.col("low") - F.col("_s")).otherwise(F.col("_e") - F.col("high")))
    start = F.when(plus, F.greatest("_s", "low") - F.col("low")).otherwise(F.col("high") - F.least("_e", "high")) + 1
    end = F.when(plus, F.least("_e", "high") - F.col("low")).otherwise(F.col("high") - F.greatest("_s", "low")) + 1
    return met.select(*[c for c in windows.columns if c != "seqid"], start.alias("sstart"), end.alias("send"), (F.col("qstart") + lost).alias("qstart"), F.when(F.col("qstart") + lost == 1, start).alias("position"), "strong", "bits", "qcov", "ordinal")

"""The tables given, seen as the engine's own: observations, reads, features, alignments.

Each view stands twice: as a DataFrame and, for the oracle, as a common table expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def obs(self) -> DataFrame:
        """Observations: a read's value at a position, for two samples."""
        return self.table("lineitem").select(
            F.concat(F.lit("chr_"), "l_returnflag").alias("chrom"), (F.col("l_partkey") + 1).alias("pos"), F.when(F.col("l_suppkey") % 2 == 1, "rev").otherwise("for").alias("strand"),
            F.when(F.col("l_linestatus") == "O", "treatment").otherwise("control").alias("sample"), F.col("l_orderkey").alias("read_id"), F.col("l_linenumber").alias("line"), F.col("l_suppkey").alias("supp"),
            F.col("l_quantity").cast("int").alias("phred"), F.pow(F.lit(10.0), -F.col("l_quantity") / 10).alias("e"), (F.col("l_extendedprice") / 10000).alias("level"), F.col("l_discount").alias("value"),
        )

    def kmer_obs(self) -> DataFrame:
        part = self.table("part").select((F.col("p_partkey") + 1).alias("pos"), F.col("p_brand").alias("kmer"))
        return self.obs().join(part, "pos")

    def genome(self) -> DataFrame:
        rows = self.obs().groupBy("chrom").agg(F.max("pos").alias("size"))
        return rows.select("chrom", "size", F.when(F.col("chrom") == "chr_A", 1).when(F.col("chrom") == "chr_N", 2).otherwise(3).alias("rank"))

    def features(self) -> DataFrame:
        key = F.col("p_partkey")
        chrom = F.element_at(F.array(F.lit("chr_A"), F.lit("chr_N"), F.lit("chr_R")), (key % 3 + 1).cast("int"))
        return self.table("part").select(key.alias("fid"), chrom.alias("chrom"), key.alias("start"), (key + F.col("p_size")).alias("end"), F.when(key % 2 == 0, "+").otherwise("-").alias("strand"))

    def reads(self) -> DataFrame:
        """A read for each order: its lines' quantities are its length."""
        return self.obs().groupBy("sample", "read_id").agg(F.sum("phred").cast("long").alias("length"), F.avg("e").alias("error"))

    def alignments(self) -> DataFrame:
        return self.table("orders").select(F.col("o_orderkey").alias("read_id"), (F.col("o_orderkey") % 4096).cast("int").alias("flag"), (F.col("o_custkey") % 61).cast("int").alias("mapq"), F.col("o_orderstatus").alias("sample"), F.floor(F.col("o_totalprice") / 100).cast("long").alias("length"), (F.col("o_custkey") % 40).cast("long").alias("mismatches"))

    def intervals(self) -> DataFrame:
        return self.table("orders").select(F.col("o_orderstatus").alias("chrom"), F.col("o_custkey").alias("start"), (F.col("o_custkey") + 10).alias("end"))

    def barcoded(self) -> DataFrame:
        code = F.lpad((F.col("user_id") % 24).cast("string"), 2, "0")
        return self.table("events").select(F.concat("event_type", F.lit("_kit_barcode"), code).alias("read_group"), F.floor(F.col("value")).cast("long").alias("bases"))

    def sequences(self) -> DataFrame:
        """Nucleotide text of the documents: a letter in four is a base, the rest is N."""
        text = F.translate("text", "EANTROISDLHUCeantroisdlhuc", "ACGTACGTACGTN" * 2)
        return self.table("documents").select("doc_id", F.regexp_replace(text, "[^ACGT]+", "N").alias("seq"))


CTES = {
    "obs": """obs AS (
  SELECT 'chr_' || l_returnflag AS chrom, l_partkey + 1 AS pos, CASE WHEN l_suppkey % 2 = 1 THEN 'rev' ELSE 'for' END AS strand,
         CASE WHEN l_linestatus = 'O' THEN 'treatment' ELSE 'control' END AS sample, l_orderkey AS read_id, l_linenumber AS line, l_suppkey AS supp,
         l_quantity::INT AS phred, power(10.0, -l_quantity / 10) AS e, l_extendedprice / 10000 AS level, l_discount AS value FROM lineitem)""",
    "kmer_obs": "kmer_obs AS (SELECT obs.*, p_brand AS kmer FROM obs JOIN part ON pos = p_partkey + 1)",
    "genome": "genome AS (SELECT chrom, max(pos) AS size, CASE chrom WHEN 'chr_A' THEN 1 WHEN 'chr_N' THEN 2 ELSE 3 END AS rank FROM obs GROUP BY chrom)",
    "features": """features AS (
  SELECT p_partkey AS fid, ['chr_A', 'chr_N', 'chr_R'][p_partkey % 3 + 1] AS chrom, p_partkey AS start, p_partkey + p_size AS "end",
         CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand FROM part)""",
    "reads": "reads AS (SELECT sample, read_id, sum(phred)::BIGINT AS length, avg(e) AS error FROM obs GROUP BY ALL)",
    "alignments": """alignments AS (
  SELECT o_orderkey AS read_id, (o_orderkey % 4096)::INT AS flag, (o_custkey % 61)::INT AS mapq, o_orderstatus AS sample,
         floor(o_totalprice / 100)::BIGINT AS length, (o_custkey % 40)::BIGINT AS mismatches FROM orders)""",
    "intervals": 'intervals AS (SELECT o_orderstatus AS chrom, o_custkey AS start, o_custkey + 10 AS "end" FROM orders)',
    "barcoded": "barcoded AS (SELECT event_type || '_kit_barcode' || lpad((user_id % 24)::VARCHAR, 2, '0') AS read_group, floor(value)::BIGINT AS bases FROM events)",
    "sequences": "sequences AS (SELECT doc_id, regexp_replace(translate(text, 'EANTROISDLHUCeantroisdlhuc', 'ACGTACGTACGTNACGTACGTACGTN'), '[^ACGT]+', 'N', 'g') AS seq FROM documents)",
    "stats": """stats AS (
  SELECT sample, chrom, pos, strand, count(*) AS cov, avg(e) AS mean, quantile_cont(e, [0.25, 0.75, 0.025, 0.975]) AS q FROM obs GROUP BY ALL)""",
    "react": """both_chroms AS (
  SELECT chrom, strand FROM stats WHERE sample = 'treatment' INTERSECT SELECT chrom, strand FROM stats WHERE sample = 'control'),
t AS (SELECT * FROM stats JOIN both_chroms USING (chrom, strand) WHERE sample = 'treatment'),
c AS (SELECT * FROM stats JOIN both_chroms USING (chrom, strand) WHERE sample = 'control'),
react AS (
  SELECT chrom, pos, strand, t.cov AS cov_t, c.cov AS cov_c, t.mean - c.mean AS reactivity,
         CASE WHEN c.cov IS NULL THEN 'treatment' WHEN t.cov IS NULL THEN 'control' ELSE 'both' END AS status
  FROM t FULL JOIN c USING (chrom, pos, strand) WHERE t.cov IS NULL OR c.cov IS NULL OR (t.cov >= 2 AND c.cov >= 2))""",
    "thr": """thr AS (
  SELECT chrom, strand, quantile_cont(-reactivity, [0.95, 0.99, 0.999, 0.9999]) AS q FROM react WHERE status = 'both' AND reactivity < 0 GROUP BY ALL)""",
    "sig": "sig AS (SELECT react.* FROM react JOIN thr USING (chrom, strand) WHERE status = 'both' AND reactivity >= q[1])",
    "model": """med AS (SELECT kmer, median(level) AS median, count(*) AS n_all FROM kmer_obs WHERE sample = 'control' GROUP BY kmer),
dev AS (SELECT kmer, level, median, n_all, abs(level - median) AS d FROM kmer_obs JOIN med USING (kmer) WHERE sample = 'control'),
mads AS (SELECT kmer, median(d) AS mad FROM dev GROUP BY kmer),
model AS (
  SELECT kmer, count(*) AS n, any_value(n_all) - count(*) AS n_outlier, avg(level) AS mean, stddev_samp(level) AS sd, any_value(median) AS median, any_value(mad) AS mad
  FROM dev JOIN mads USING (kmer) WHERE d <= 1.5 * mad GROUP BY kmer)""",
    "scored": "scored AS (SELECT o.*, (level - mean) / sd AS z FROM kmer_obs o JOIN model m USING (kmer) WHERE m.n >= 30 AND sd > 0)",
}
_NEEDS = {"kmer_obs": ["obs"], "genome": ["obs"], "reads": ["obs"], "stats": ["obs"], "react": ["stats"], "thr": ["react"], "sig": ["thr"], "model": ["kmer_obs"], "scored": ["model"]}


def with_views(names: str, select: str) -> str:
    """A statement with the named expressions, and those they need, before it."""
    order: list[str] = []

    def add(name: str) -> None:
        for n in _NEEDS.get(name, []):
            add(n)
        if name not in order:
            order.append(name)

    for n in names.split():
        add(n)
    head = "WITH RECURSIVE " if "RECURSIVE" in select else "WITH "
    select = select.replace("RECURSIVE", "").strip()
    if select.upper().startswith("AND "):
        return head + ",\n".join(CTES[n] for n in order) + ",\n" + select[4:]
    return (head + ",\n".join(CTES[n] for n in order) + "\n" if order else "") + select

"""Queries of the engine's own operators over the driver's tables, by name, with their SQL.

Stand-ins: a document is a genome (lang its category, source its taxonomic group), `benchmark` the masking
reference, `orders` a dated accession catalog, `labels` a classifier's scores.  Each query runs over whole tables
and whole texts; only fixed_chunks_budget and unambiguous_reads_budget show a budget of candidate positions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom import rng
from readloom.functions import sequences as sq
from readloom.operators import budgets, chunking, gapped, intervals, kmers, lookup, perturb, sampling, scoring, similarity, temporal
from readloom.sources import remote, sinks

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

#: Categories that languages stand for.
CATEGORY = {"de": "bacteria", "en": "virus", "es": "archaea", "fr": "plasmid"}
LENGTH, BUDGET, SEED = 250, 20, 42


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return keep


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def genomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    category = F.coalesce(*[F.when(F.col("lang") == k, v) for k, v in CATEGORY.items()], F.lit("other"))
    return read(spark, sf_dir, "documents").select(F.col("doc_id").alias("genome_id"), category.alias("category"), F.col("source").alias("group"), F.col("text").alias("seq"))


def budgeted(df: DataFrame, n: int = BUDGET) -> DataFrame:
    """df with a budget of n candidate positions each."""
    return df.withColumn("read_limit", F.lit(n).cast("long"))


# SQL of the same stand-ins.
_G = "g AS (SELECT doc_id AS genome_id, CASE lang WHEN 'de' THEN 'bacteria' WHEN 'en' THEN 'virus' WHEN 'es' THEN 'archaea' WHEN 'fr' THEN 'plasmid' ELSE 'other' END AS category, source AS grp, text AS seq FROM documents)"
_U = lambda key: f"(('0x' || substr(md5({key}), 1, 8))::UBIGINT / 4294967296.0)"


def _reads_sql(most: str) -> str:
    return f"""{_G}, n AS (SELECT *, {most} AS k FROM g),
    r AS (SELECT genome_id, category, grp, i AS chunk_idx, genome_id || '_read_' || i AS read_id, i * {LENGTH} AS "start", (i + 1) * {LENGTH} AS "end", substr(seq, CAST(i * {LENGTH} + 1 AS BIGINT), {LENGTH}) AS seq
          FROM (SELECT *, unnest(range(0, k)) AS i FROM n WHERE k > 0))"""


_READS, _SOME_READS = _reads_sql(f"length(seq) // {LENGTH}"), _reads_sql(f"least(length(seq) // {LENGTH}, {BUDGET})")


def reads_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.fixed_reads(genomes(spark, sf_dir), LENGTH)


@query("fixed_chunks", f'WITH {_READS} SELECT genome_id, category, read_id, chunk_idx, "start", "end", seq FROM r')
def fixed_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads_of(spark, sf_dir).select("genome_id", "category", "read_id", "chunk_idx", "start", "end", "seq")


@query("fixed_chunks_budget", f'WITH {_SOME_READS} SELECT genome_id, read_id, chunk_idx FROM r')
def fixed_chunks_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The read budget: at most BUDGET reads a genome, its first ones."""
    return chunking.fixed_reads(budgeted(genomes(spark, sf_dir)), LENGTH).select("genome_id", "read_id", "chunk_idx")


@query("fixed_chunk_abundance", f"WITH {_READS}, c AS (SELECT genome_id, count(*) AS read_count FROM r GROUP BY genome_id) SELECT genome_id, read_count, read_count / sum(read_count) OVER () AS proportion FROM c")
def fixed_chunk_abundance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.abundance(chunking.fixed_reads(genomes(spark, sf_dir).select("genome_id", "seq"), LENGTH))


_CONTIGS = f"""{_G}, n AS (SELECT *, length(seq) AS total, CAST(ceil(length(seq) / 100.0) AS BIGINT) AS k FROM g),
    d AS (SELECT genome_id, seq, total, i, 100 + CAST(floor({_U("'42:' || genome_id || ':' || i")} * 301) AS BIGINT) AS span FROM (SELECT *, unnest(range(0, k)) AS i FROM n WHERE k > 0)),
    p AS (SELECT *, coalesce(sum(span) OVER (PARTITION BY genome_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS s FROM d),
    q AS (SELECT *, least(s + span, total) AS e FROM p)"""


@query("variable_contigs", f"""WITH {_CONTIGS} SELECT genome_id, genome_id || '_contig_' || i AS read_id, i AS chunk_idx, s AS "start", e AS "end", substr(seq, s + 1, e - s) AS seq FROM q WHERE e - s >= 100""")
def variable_contigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.variable_contigs(genomes(spark, sf_dir), 100, 400, SEED).select("genome_id", "read_id", "chunk_idx", "start", "end", "seq")


@query("genome_stats", f"WITH {_G} SELECT genome_id, CAST(sum(length(seq)) AS BIGINT) AS total_bases, CAST(sum(length(seq)) // {LENGTH} AS BIGINT) AS max_reads FROM g GROUP BY genome_id")
def genome_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return budgets.genome_stats(genomes(spark, sf_dir), LENGTH)


@query("variable_genome_stats", f"WITH {_G} SELECT genome_id, CAST(sum(length(seq)) AS BIGINT) AS total_bases, CAST(sum(length(seq)) // 250 AS BIGINT) AS max_reads FROM g GROUP BY genome_id")
def variable_genome_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return budgets.genome_stats(genomes(spark, sf_dir), min_length=100, max_length=400)


@query("balanced_budget", "SELECT doc_id AS genome_id, CAST(length(text) AS BIGINT) AS total_bases, CAST(length(text) // 10 AS BIGINT) AS max_reads, CAST(min(length(text) // 10) OVER () AS BIGINT) AS read_limit FROM documents")
def balanced_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return budgets.balanced(budgets.genome_stats(genomes(spark, sf_dir), 10))


@query("weighted_budget", f"WITH {_G} SELECT genome_id, category, CAST(greatest(1, floor(1000 * CASE category WHEN 'bacteria' THEN 0.5 WHEN 'virus' THEN 2.0 WHEN 'archaea' THEN 0.0 ELSE 1.0 END)) AS BIGINT) AS read_limit FROM g")
def weighted_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return budgets.weighted(genomes(spark, sf_dir).select("genome_id", "category"), 1000, sq.parse_weights("bacteria=0.5,virus=2,archaea=0"))


@query("exponential_budget", f"WITH w AS (SELECT doc_id AS genome_id, CAST(round(-ln(1 - {_U(chr(39) + '42:' + chr(39) + ' || doc_id')}) * 1e6) AS BIGINT) AS w FROM documents) SELECT genome_id, CAST(greatest(1, (1000 * w * count(*) OVER ()) // sum(w) OVER ()) AS BIGINT) AS read_limit FROM w")
def exponential_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return budgets.exponential(genomes(spark, sf_dir).select("genome_id"), 1000, SEED)


@query("taxonomy_budget", f"""WITH {_G}, s AS (SELECT genome_id, category, grp, length(seq) // {LENGTH} AS max_reads FROM g),
    c AS (SELECT grp, sum(max_reads) AS capacity, count(*) AS members FROM s WHERE category = 'virus' GROUP BY grp),
    t AS (SELECT min(capacity) AS target FROM c), h AS (SELECT grp, greatest(1, target // members) AS share FROM c, t WHERE target > 0)
    SELECT genome_id, s.grp AS "group", CAST(max_reads AS BIGINT) AS max_reads, CAST(CASE WHEN category = 'virus' AND share IS NOT NULL THEN least(max_reads, share) ELSE {BUDGET} END AS BIGINT) AS read_limit FROM s LEFT JOIN h USING (grp)""")
def taxonomy_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = genomes(spark, sf_dir)
    stats = g.select("genome_id", "category", F.expr(f"CAST(length(seq) div {LENGTH} AS BIGINT)").alias("max_reads"), F.lit(BUDGET).cast("long").alias("read_limit"))
    return budgets.by_taxonomy(stats, g.select("genome_id", "group")).select("genome_id", "group", "max_reads", "read_limit")


_PLAIN = f"WHERE translate(translate(seq, '{sq.LOWER}', '{sq.UPPER}'), '{sq.UPPER} .,' || chr(10), '') = ''"


@query("unambiguous_reads", f"WITH {_READS} SELECT genome_id, read_id, chunk_idx FROM r {_PLAIN}")
def unambiguous_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads_of(spark, sf_dir).filter(sq.is_unambiguous("seq", sq.UPPER + " .,\n")).select("genome_id", "read_id", "chunk_idx")


@query("unambiguous_reads_budget", f"WITH {_SOME_READS} SELECT genome_id, read_id, chunk_idx FROM r {_PLAIN}")
def unambiguous_reads_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The budget comes before the filter: what is rejected is not replaced."""
    reads = chunking.fixed_reads(budgeted(genomes(spark, sf_dir)), LENGTH)
    return reads.filter(sq.is_unambiguous("seq", sq.UPPER + " .,\n")).select("genome_id", "read_id", "chunk_idx")


# --- similarity ------------------------------------------------------------------------------------


def _mask_sql(kmer: str, k: int) -> str:
    return "(" + " OR ".join(f"substr({kmer}, 1, {k - p}) = substr({kmer}, {p + 1}, {k - p})" for p in similarity.PERIODS) + ")"


def _kmers_sql(table: str, k: int, masked: bool = True) -> str:
    """All k-mers; seeds are equal on both sides, so one side's mask is enough."""
    every = f"SELECT id, i AS pos, substr(seq, CAST(i + 1 AS BIGINT), {k}) AS kmer FROM (SELECT id, seq, unnest(range(0, length(seq) - {k} + 1)) AS i FROM {table} WHERE length(seq) >= {k})"
    return f"(SELECT * FROM ({every}) WHERE NOT {_mask_sql('kmer', k)})" if masked else f"({every})"


def _alignments_sql(q: str, s: str, k: int, bases: int) -> str:
    return f"""(SELECT q, s, qstart, qend, qstart - off AS sstart, len AS length, list_sum(list_transform(range(1, CAST(len + 1 AS BIGINT)), lambda i: CASE WHEN substr(qpart, i, 1) = substr(spart, i, 1) THEN 1 ELSE 0 END)) AS matches, qlen FROM
      (SELECT h.*, substr(a.seq, CAST(qstart + 1 AS BIGINT), CAST(len AS BIGINT)) AS qpart, substr(b.seq, CAST(qstart - off + 1 AS BIGINT), CAST(len AS BIGINT)) AS spart, length(a.seq) AS qlen FROM
        (SELECT q, s, off, min(qpos) AS qstart, max(qpos) + {k} AS qend, max(qpos) + {k} - min(qpos) AS len FROM
          (SELECT x.id AS q, y.id AS s, x.pos AS qpos, x.pos - y.pos AS off FROM {_kmers_sql(q, k, False)} x JOIN {_kmers_sql(s, k)} y ON x.kmer = y.kmer WHERE x.id <> y.id) GROUP BY q, s, off) h
        JOIN {q} a ON a.id = h.q JOIN {s} b ON b.id = h.s WHERE len >= {bases}))"""


def _similar_sql(q: str, s: str, identity: int = 90, coverage: float = 0.8, k: int = 28) -> str:
    """(q, s) with a seeded diagonal on which some stretch, of coverage of q at least, is equal enough.

    Equal places count 100 - identity and others - identity: a stretch is equal enough if its sum isn't negative.
    """
    return f"""(WITH dg AS MATERIALIZED (SELECT DISTINCT x.id AS q, y.id AS s, x.pos - y.pos AS off FROM {_kmers_sql(q, k)} x JOIN {_kmers_sql(s, k, False)} y ON x.kmer = y.kmer WHERE x.id <> y.id),
      dl AS (SELECT dg.*, greatest(0, off) AS a0, least(length(a.seq), length(b.seq) + off) - greatest(0, off) AS n, CAST(ceil(length(a.seq) * {coverage}::DOUBLE) AS BIGINT) AS need FROM dg JOIN {q} a ON a.id = dg.q JOIN {s} b ON b.id = dg.s),
      dn AS MATERIALIZED (SELECT * FROM dl WHERE n >= need),
      qc AS (SELECT id, unnest(string_split(seq, '')) AS c, unnest(range(0, length(seq))) AS p FROM {q} WHERE id IN (SELECT q FROM dn)),
      sc AS (SELECT id, unnest(string_split(seq, '')) AS c, unnest(range(0, length(seq))) AS p FROM {s} WHERE id IN (SELECT s FROM dn)),
      pl AS (SELECT *, unnest(range(0, n)) AS i FROM dn),
      ev AS (SELECT pl.q, pl.s, off, need, i, CASE WHEN qc.c = sc.c THEN {100 - identity} ELSE {-identity} END AS v FROM pl JOIN qc ON qc.id = pl.q AND qc.p = a0 + i JOIN sc ON sc.id = pl.s AND sc.p = a0 - off + i UNION ALL SELECT q, s, off, need, -1, 0 FROM dn),
      us AS MATERIALIZED (SELECT q, s, off, need, i, sum(v) OVER (PARTITION BY q, s, off ORDER BY i) AS u FROM ev),
      wl AS (SELECT q, s, u, min(u) OVER (PARTITION BY q, s, off ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND need PRECEDING) AS low FROM us)
      SELECT DISTINCT q, s FROM wl WHERE u >= low)"""


def sequences_of(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(documents, reference) as id, seq."""
    return genomes(spark, sf_dir).select(F.col("genome_id").alias("id"), "seq"), read(spark, sf_dir, "benchmark").select((-F.col("item_id") - 1).alias("id"), F.col("text").alias("seq"))


_DOCS_REF = "d AS (SELECT doc_id AS id, text AS seq FROM documents), b AS (SELECT -item_id - 1 AS id, text AS seq FROM benchmark)"
_HITS = f"{_DOCS_REF}, a AS (SELECT * FROM {_alignments_sql('d', 'b', 16, 50)} WHERE matches * 100 >= length * 70.0)"
_MERGED = """m AS (SELECT genome_id, min("start") AS "start", max("end") AS "end" FROM (SELECT *, sum(opens) OVER (PARTITION BY genome_id ORDER BY "start", "end" ROWS UNBOUNDED PRECEDING) AS island FROM
    (SELECT *, CASE WHEN "start" > max("end") OVER w OR max("end") OVER w IS NULL THEN 1 ELSE 0 END AS opens FROM (SELECT DISTINCT q AS genome_id, qstart AS "start", qend AS "end" FROM a)
     WINDOW w AS (PARTITION BY genome_id ORDER BY "start", "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))) GROUP BY genome_id, island)"""


def masked_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged places of documents that align with the reference: 70 % identity over 50 characters."""
    docs, reference = sequences_of(spark, sf_dir)
    hits = similarity.alignments(docs, reference, k=16, min_bases=50).filter(F.col("matches") * 100 >= F.col("length") * 70.0)
    return intervals.merge_intervals(hits.select(F.col("q").alias("genome_id"), F.col("qstart").alias("start"), F.col("qend").alias("end")), ["genome_id"])


@query("contamination_intervals", f'WITH {_HITS}, {_MERGED} SELECT genome_id, "start", "end" FROM m')
def contamination_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masked_intervals(spark, sf_dir)


@query("masked_reads", f'WITH {_READS}, {_HITS}, {_MERGED} SELECT genome_id, read_id, "start", "end" FROM r WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.genome_id = r.genome_id AND r."start" < m."end" AND r."end" > m."start")')
def masked_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.mask_reads(reads_of(spark, sf_dir), masked_intervals(spark, sf_dir), ["genome_id"]).select("genome_id", "read_id", "start", "end")


@query("interval_export", f"""WITH {_HITS}, {_MERGED} SELECT m.genome_id || '|' || ("start" + 1) || '-' || "end" AS region_id, substr(text, "start" + 1, "end" - "start") AS seq FROM m JOIN documents ON doc_id = genome_id WHERE "end" - "start" >= 60""")
def interval_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.export_regions(genomes(spark, sf_dir), masked_intervals(spark, sf_dir), ["genome_id"], min_length=60)


_RS = f"{_READS}, t AS (SELECT read_id AS id, seq, chunk_idx, genome_id FROM r), m AS (SELECT id, seq, min(id) OVER (PARTITION BY seq) AS rep FROM t), u AS (SELECT id, seq FROM m WHERE id = rep)"
_SEEDED = f"sd AS (SELECT DISTINCT id AS rep FROM {_kmers_sql('u', 28)})"
_PAIRS = f"{_RS}, {_SEEDED}, pairs AS {_similar_sql('u', 'u')}"


def read_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads_of(spark, sf_dir).select(F.col("read_id").alias("id"), "genome_id", "chunk_idx", "seq")


@query("similar_pairs", f"WITH {_PAIRS} SELECT q, s, 'similar' AS kind FROM pairs UNION ALL SELECT id, rep, 'same' FROM m JOIN sd USING (rep) WHERE id <> rep")
def similar_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of different texts, by the smallest ids of each, and for every other copy the one that stands for it."""
    found = similarity.similar_texts(read_table(spark, sf_dir).select("id", "seq"))
    same = found.members.filter("seeded and id <> rep").select(F.col("id").alias("q"), F.col("rep").alias("s"), F.lit("same").alias("kind"))
    return found.pairs.select("q", "s", F.lit("similar").alias("kind")).unionByName(same)


_ITEMS = "it AS (SELECT 'item' || item_id AS id, CASE WHEN item_id % 2 = 0 THEN reverse(translate(text, 'ACGTacgt', 'TGCAtgca')) ELSE text END AS seq FROM benchmark)"


@query("similar_on_both_strands", f"""WITH {_ITEMS}, dd AS (SELECT 'doc' || doc_id AS id, text AS seq FROM documents), bs AS (SELECT id || '+' AS id, seq FROM it UNION ALL SELECT id || '-', reverse(translate(seq, 'ACGTacgt', 'TGCAtgca')) FROM it)
    SELECT DISTINCT rtrim(q, '+-') AS id FROM {_similar_sql('bs', 'dd')}""")
def similar_on_both_strands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of the reference that a document holds, every second one turned to the other strand first."""
    text = F.when(F.col("item_id") % 2 == 0, sq.reverse_complement("text")).otherwise(F.col("text"))
    items = read(spark, sf_dir, "benchmark").select(F.concat(F.lit("item"), F.col("item_id").cast("string")).alias("id"), text.alias("seq"))
    docs = genomes(spark, sf_dir).select(F.concat(F.lit("doc"), F.col("genome_id").cast("string")).alias("id"), "seq")
    return similarity.similar_to(items, docs, both_strands=True).select("id")


# --- gapped alignments -----------------------------------------------------------------------------

_SCORING = gapped.Scoring()
_STEP = f"({_SCORING.extend} * {gapped.UNIT}::BIGINT * {gapped.UNIT} + 1)"
_OPEN = f"({_SCORING.open} * {gapped.UNIT}::BIGINT * {gapped.UNIT})"
_NEVER = "(-2305843009213693952)::BIGINT"


def _cut_kmers_sql(table: str, k: int, masked: bool = True, more: str = "") -> str:
    """As _kmers_sql, from blocks: substr counts characters from its text's start."""
    blocks = f"SELECT id{more}, b * 512 AS base, substr(seq, b * 512 + 1, {511 + k}) AS part FROM (SELECT id{more}, seq, unnest(range(0, (length(seq) - {k}) // 512 + 1)) AS b FROM {table} WHERE length(seq) >= {k})"
    every = f"SELECT id{more}, base + i AS pos, substr(part, i + 1, {k}) AS kmer FROM (SELECT *, unnest(range(0, length(part) - {k} + 1)) AS i FROM ({blocks}))"
    return f"(SELECT * FROM ({every}) WHERE NOT {_mask_sql('kmer', k)})" if masked else f"({every})"


def _strands_sql(table: str) -> str:
    return f"(SELECT id, '+' AS strand, seq FROM {table} UNION ALL SELECT id, '-', reverse(translate(seq, 'ACGTacgt', 'TGCAtgca')) FROM {table})"


def _gapped_sql(q: str, s: str, k: int = 28, gap: int = gapped.GAP, most: int | None = None) -> str:
    """Tables of a WITH RECURSIVE: sd (seeds of a pair), bp (bands), dp (the banded recurrence, a row for each query letter) and ga (the best of each pair).

    q has id, strand and seq.  A cell's value is score x UNIT^2 + matches x UNIT - columns; h holds a band's row, f its gaps down.
    """
    width, size = gapped.BUCKET + 2 * gap, gapped.BUCKET
    unit = f"{gapped.UNIT}::BIGINT"
    match, miss = f"({_SCORING.reward} * {unit} * {unit} + {unit} - 1)", f"(-{_SCORING.penalty} * {unit} * {unit} - 1)"
    top = f"WHERE rank <= {most}" if most else ""
    return f"""
    sd AS MATERIALIZED (
      SELECT x.id AS q, y.id AS s, strand, CAST(floor((x.pos - y.pos) / {size}.0) AS BIGINT) AS bucket, count(*) AS seeds FROM {_cut_kmers_sql(q, k, False, ", strand")} x JOIN {_cut_kmers_sql(s, k)} y ON x.kmer = y.kmer WHERE x.id <> y.id GROUP BY ALL),
    tp AS (SELECT q, s FROM (SELECT q, s, row_number() OVER (PARTITION BY q ORDER BY sum(seeds) DESC, s) AS rank FROM sd GROUP BY q, s) {top}),
    bp AS MATERIALIZED (
      SELECT sd.q, sd.s, sd.strand, sd.bucket, a.seq AS qseq, sd.bucket * {size} + {size - 1 + gap} AS high, greatest(0, -(sd.bucket * {size} + {size - 1 + gap})) AS sfrom,
       substr(b.seq, greatest(0, -(sd.bucket * {size} + {size - 1 + gap})) + 1, length(a.seq) + {width}) AS spart
      FROM sd JOIN tp ON tp.q = sd.q AND tp.s = sd.s JOIN {q} a ON a.id = sd.q AND a.strand = sd.strand JOIN {s} b ON b.id = sd.s),
    dp AS (
      SELECT q, s, strand, bucket, qseq, high, sfrom, spart, 0::BIGINT AS i, list_transform(range(1, {width + 1}), lambda j: 0::BIGINT) AS h, list_transform(range(1, {width + 1}), lambda j: {_NEVER}) AS f,
       0::BIGINT AS best, 0::BIGINT AS qend, 0::BIGINT AS send FROM bp
      UNION ALL
      SELECT q, s, strand, bucket, qseq, high, sfrom, spart, i + 1, h3, f2, greatest(best, list_max(h3)), CASE WHEN list_max(h3) > best THEN i + 1 ELSE qend END,
       CASE WHEN list_max(h3) > best THEN i - high + list_position(h3, list_max(h3)) ELSE send END
      FROM (
       SELECT *, list_transform(range(1, {width + 1}), lambda j: greatest(h2[j], coalesce(list_max(list_transform(range(1, j), lambda m: h2[m] - {_OPEN} - (j - m) * {_STEP})), 0))) AS h3 FROM (
        SELECT *, list_transform(range(1, {width + 1}), lambda j: greatest(0, f2[j], CASE WHEN i - high + j - 1 - sfrom < 0 OR i - high + j - 1 - sfrom >= length(spart) THEN 0
          WHEN substr(qseq, i + 1, 1) = substr(spart, i - high + j - sfrom, 1) THEN h[j] + {match} ELSE h[j] + {miss} END)) AS h2 FROM (
         SELECT *, list_transform(range(1, {width + 1}), lambda j: CASE WHEN j = {width} THEN {_NEVER} ELSE greatest(h[j + 1] - {_OPEN}, f[j + 1]) - {_STEP} END) AS f2 FROM dp WHERE i < length(qseq))))),
    ga AS (
      SELECT q, s, strand, score, matches, matches * {unit} - rest AS length, qend, send, qlen FROM (
       SELECT *, CAST(ceil(rest / {gapped.UNIT}.0) AS BIGINT) AS matches FROM (SELECT q, s, strand, best // ({unit} * {unit}) AS score, best % ({unit} * {unit}) AS rest, qend, send, length(qseq) AS qlen FROM dp WHERE i = length(qseq) AND best > 0))
      QUALIFY row_number() OVER (PARTITION BY q, s ORDER BY score DESC, matches DESC, matches * {unit} - rest, strand, qend, send) = 1)"""


_GAPPED = "bm AS (SELECT item_id AS id, text AS seq FROM benchmark), dr AS (SELECT doc_id AS id, CASE WHEN doc_id % 2 = 1 THEN reverse(translate(text, 'ACGTacgt', 'TGCAtgca')) ELSE text END AS seq FROM documents)"


def turned(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(items of the reference, documents, those of odd id turned to the other strand)."""
    items = read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), F.col("text").alias("seq"))
    text = F.when(F.col("doc_id") % 2 == 1, sq.reverse_complement("text")).otherwise(F.col("text"))
    return items, read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), text.alias("seq"))


@query("gapped_hits", f"WITH RECURSIVE {_GAPPED}, ib AS {_strands_sql('bm')}, {_gapped_sql('ib', 'dr')} SELECT q, s, strand, score, matches, length, qend, send FROM ga")
def gapped_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best gapped alignment of each item and document that share a seed on either strand."""
    found = gapped.gapped_alignments(*turned(spark, sf_dir), both_strands=True)
    return found.select("q", "s", "strand", "score", "matches", "length", "qend", "send")


_EVALUES = f"""ql AS (SELECT c, count(*) AS n FROM (SELECT unnest(string_split(seq, '')) AS c FROM bm) GROUP BY 1), sl AS (SELECT c, count(*) AS n FROM (SELECT unnest(string_split(seq, '')) AS c FROM dr) GROUP BY 1),
    eq AS (SELECT (SELECT sum(ql.n * sl.n::DOUBLE) FROM ql JOIN sl USING (c)) / ((SELECT sum(n) FROM ql)::DOUBLE * (SELECT sum(n) FROM sl)) AS p, (SELECT sum(n) FROM sl)::DOUBLE AS letters, (SELECT count(*) FROM dr) AS subjects),
    la AS (SELECT 0.0::DOUBLE AS lo, 8.0::DOUBLE AS hi, 0 AS i UNION ALL
      SELECT CASE WHEN g < 0 THEN (lo + hi) / 2 ELSE lo END, CASE WHEN g < 0 THEN hi ELSE (lo + hi) / 2 END, i + 1
      FROM (SELECT *, p * exp({_SCORING.reward} * (lo + hi) / 2) + (1 - p) * exp(-{_SCORING.penalty} * (lo + hi) / 2) - 1 AS g FROM la, eq WHERE i < 100)),
    st AS (SELECT hi AS rate, hi * (p * {_SCORING.reward} * exp({_SCORING.reward} * hi) - (1 - p) * {_SCORING.penalty} * exp(-{_SCORING.penalty} * hi)) AS entropy, letters, subjects FROM la, eq WHERE i = 100),
    ev AS (SELECT *, greatest(0, floor(ln({_SCORING.k} * qlen * letters) / entropy)) AS less FROM ga, st),
    le AS (SELECT *, log10({_SCORING.k} * greatest(1, qlen - less) * greatest(1, letters - less * subjects)) - score * rate / ln(10) AS log10_evalue, (score * rate - ln({_SCORING.k})) / ln(2) AS bits FROM ev)"""


@query("gapped_evalues", f"WITH RECURSIVE {_GAPPED}, ib AS {_strands_sql('bm')}, {_gapped_sql('ib', 'dr')}, {_EVALUES} SELECT q, s, round(bits, 2) AS bits, round(log10_evalue, 2) AS log10_evalue FROM le WHERE log10_evalue <= -60")
def gapped_evalues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignments that chance explains less than once in 10^60 such searches, with their bit scores."""
    found = gapped.gapped_alignments(*turned(spark, sf_dir), both_strands=True, max_evalue=1e-60)
    return found.select("q", "s", F.round("bits", 2).alias("bits"), F.round("log10_evalue", 2).alias("log10_evalue"))


_SHORTENED = """bm AS (SELECT item_id AS id, substr(text, 1, CAST(length(text) // 2 AS BIGINT)) || substr(text, CAST(length(text) // 2 + 5 AS BIGINT)) AS seq FROM benchmark WHERE length(text) >= 40), dr AS (SELECT -doc_id - 1 AS id, text AS seq FROM documents),
    ib AS (SELECT id, '+' AS strand, seq FROM bm)"""


def shortened(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(items that lack four letters in their middle, documents)."""
    middle = F.expr("length(text) div 2")
    text = F.concat(F.substring("text", F.lit(1), middle), F.expr("substring(text, cast(length(text) div 2 + 5 as int))"))
    items = read(spark, sf_dir, "benchmark").filter(F.length("text") >= 40).select(F.col("item_id").alias("id"), text.alias("seq"))
    return items, read(spark, sf_dir, "documents").select((-F.col("doc_id") - 1).alias("id"), F.col("text").alias("seq"))


@query("similar_with_gaps", f"WITH RECURSIVE {_SHORTENED}, {_gapped_sql('ib', 'dr')} SELECT DISTINCT q AS id FROM ga WHERE matches * 100 >= length * 90 AND length >= qlen * 0.8")
def similar_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items that lack letters and are still similar to a document."""
    return similarity.similar_to(*shortened(spark, sf_dir), gap=gapped.GAP).select("id")


@query("gapped_top_subjects", f"WITH RECURSIVE {_SHORTENED}, {_gapped_sql('ib', 'dr', most=2)} SELECT q, s, score, matches, length FROM ga")
def gapped_top_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each shortened item the two documents with most seeds, the smaller id first among equals."""
    return gapped.gapped_alignments(*shortened(spark, sf_dir), max_subjects=2).select("q", "s", "score", "matches", "length")


# --- splits and choices ----------------------------------------------------------------------------

_SPLIT = "sp AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY md5('42:' || read_id), read_id) <= greatest(1, CAST(floor(count(*) OVER () * 80.0 / 100) AS BIGINT)) THEN 'train' ELSE 'test' END AS split FROM r)"


@query("train_test_split", f"WITH {_READS}, {_SPLIT} SELECT read_id, split FROM sp")
def train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.train_test(reads_of(spark, sf_dir).select("read_id"), 80, SEED)


_TEST_TRAIN = f"{_READS}, {_SPLIT}, tr AS (SELECT read_id AS id, seq FROM sp WHERE split = 'train'), te AS (SELECT read_id AS id, seq FROM sp WHERE split = 'test'), gone AS (SELECT DISTINCT q FROM {_similar_sql('te', 'tr')})"


def split_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(test, train) reads."""
    split = sampling.train_test(read_table(spark, sf_dir).select("id", "seq"), 80, SEED, by="id")
    return tuple(split.filter(F.col("split") == s).select("id", "seq") for s in ("test", "train"))


@query("test_minus_train", f"WITH {_TEST_TRAIN} SELECT id FROM te WHERE id NOT IN (SELECT q FROM gone)")
def test_minus_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.drop_similar(*split_sides(spark, sf_dir)).select("id")


@query("filter_statistics", f"WITH {_TEST_TRAIN} SELECT count(*) AS n, count(*) - (SELECT count(*) FROM gone) AS kept, (SELECT count(*) FROM gone) AS removed FROM te")
def filter_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many test reads the similarity filter removes and keeps."""
    test, train = split_sides(spark, sf_dir)
    return similarity.filter_statistics(test, similarity.drop_similar(test, train))


@query("dedup_batched", f"""WITH {_READS}, ea AS (SELECT read_id AS id, seq FROM r WHERE chunk_idx < 5), la AS (SELECT read_id AS id, seq FROM r WHERE chunk_idx >= 5)
    SELECT id FROM ea UNION ALL SELECT id FROM la WHERE id NOT IN (SELECT q FROM {_similar_sql('la', 'ea')})""")
def dedup_batched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches, the first five reads of each genome and the others: within a batch nothing is compared."""
    reads = read_table(spark, sf_dir)
    return similarity.greedy_choice(reads, reads.select("id", (F.col("chunk_idx") >= 5).cast("long").alias("rank")), batch=1).select("id")


@query("dedup_strict", f"""WITH RECURSIVE {_PAIRS}, ra AS (SELECT id, row_number() OVER (ORDER BY chunk_idx, genome_id) AS rank FROM t),
    cl AS (SELECT rep, min(rank) AS rank FROM m JOIN ra USING (id) JOIN sd USING (rep) GROUP BY rep),
    ed AS (SELECT q, s FROM pairs JOIN cl a ON a.rep = q JOIN cl b ON b.rep = s WHERE b.rank < a.rank),
    st AS (SELECT 0 AS round, id, CASE WHEN id IN (SELECT q FROM ed) THEN NULL ELSE true END AS kept FROM (SELECT q AS id FROM ed UNION SELECT s FROM ed)
      UNION ALL SELECT w.round + 1, w.id, CASE WHEN w.kept IS NOT NULL THEN w.kept WHEN any_kept THEN false WHEN NOT any_open THEN true END FROM (SELECT * FROM st WHERE EXISTS (SELECT 1 FROM st WHERE kept IS NULL)) w
        LEFT JOIN (SELECT ed.q, bool_or(coalesce(x.kept, false)) AS any_kept, bool_or(x.kept IS NULL) AS any_open FROM ed JOIN st x ON x.id = ed.s GROUP BY ed.q) v ON v.q = w.id),
    gone AS (SELECT id FROM st WHERE round = (SELECT max(round) FROM st) AND NOT kept)
    SELECT id FROM m JOIN ra USING (id) LEFT JOIN cl USING (rep) WHERE cl.rep IS NULL OR (ra.rank = cl.rank AND rep NOT IN (SELECT id FROM gone))""")
def dedup_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ordered greedy choice over all reads, by (chunk_idx, genome_id)."""
    reads = read_table(spark, sf_dir)
    return similarity.greedy_choice(reads, reads.select("id", (F.col("chunk_idx") * F.lit(1 << 40) + F.col("genome_id")).alias("rank"))).select("id")


_ATTEMPTS = "c AS (SELECT attempt, doc_id AS id, text AS seq FROM (SELECT *, row_number() OVER (PARTITION BY attempt, lang ORDER BY md5((42 + attempt) || ':' || doc_id), doc_id) AS rn FROM documents, (SELECT unnest(range(0, 3)) AS attempt) WHERE source <> 'src0') WHERE rn <= 20), p AS (SELECT doc_id AS id, text AS seq FROM documents WHERE source = 'src0'), u AS (SELECT DISTINCT id, seq FROM c)"
_PENALTY = f"{_ATTEMPTS}, sim AS {_similar_sql('u', 'p')}, pen AS (SELECT attempt, count(DISTINCT q) AS penalty FROM c LEFT JOIN sim ON q = id GROUP BY attempt)"


@query("diversity_penalty", f"WITH {_PENALTY} SELECT attempt, penalty FROM pen")
def diversity_penalty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three attempts at 20 genomes of each category, against those of one earlier replicate (source src0)."""
    g = genomes(spark, sf_dir)
    rest = g.filter(F.col("group") != "src0")
    attempts = None
    for attempt in range(3):
        chosen = sampling.stratified(rest, dict.fromkeys(CATEGORY.values(), 20), SEED + attempt, by="genome_id").select(F.lit(attempt).cast("long").alias("attempt"), F.col("genome_id").alias("id"), "seq")
        attempts = chosen if attempts is None else attempts.unionByName(chosen)
    return similarity.diversity_penalty(attempts, g.filter(F.col("group") == "src0").select(F.col("genome_id").alias("id"), "seq"))


@query("best_candidate", f"WITH {_PENALTY} SELECT attempt, penalty FROM pen ORDER BY penalty, attempt LIMIT 1")
def best_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.best_attempt(diversity_penalty(spark, sf_dir))


@query("kmer_index", f"WITH b AS (SELECT item_id AS id, text AS seq FROM benchmark) SELECT id, pos, kmer FROM {_kmers_sql('b', 28)}")
def kmer_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.kmer_index(read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), F.col("text").alias("seq")))


_DUST = f"""h AS (SELECT o_custkey AS id, string_agg(o_orderstatus, '' ORDER BY o_orderdate, o_orderkey) AS seq FROM orders GROUP BY 1),
    t AS (SELECT id, i, substr(seq, i, 3) AS t, length(seq) - 2 AS n FROM (SELECT id, seq, unnest(range(1, length(seq) - 1)) AS i FROM h WHERE length(seq) > 3)),
    s AS (
      SELECT id, i, t, n, 0 AS steps, 0 AS before, 0 AS pairs, 0.0::DOUBLE AS own, 0.0::DOUBLE AS inner_, 0.0::DOUBLE AS most FROM t
      UNION ALL
      SELECT id, i, t, n, steps, before, pairs, own, inner_, greatest(own, inner_) FROM (
       SELECT *, CASE WHEN i + steps <= n THEN pairs / steps ELSE 0 END AS own, greatest(most, coalesce(lead(most) OVER (PARTITION BY id ORDER BY i), 0)) AS inner_ FROM (
        SELECT id, i, t, n, most, steps, before, old + coalesce(lead(before, steps) OVER (PARTITION BY id ORDER BY i), 0) AS pairs FROM (
         SELECT id, i, t, n, most, pairs AS old, steps + 1 AS steps, before + CASE WHEN lag(t, steps + 1) OVER (PARTITION BY id ORDER BY i) = t THEN 1 ELSE 0 END AS before FROM s WHERE steps < {kmers.DUST_WINDOW - 3})))),
    f AS (SELECT DISTINCT id, unnest(range(i - 1, i + steps + 2)) AS p FROM s WHERE steps > 0 AND own > {kmers.DUST_SCORE} AND own >= inner_)"""


@query("low_complexity", f"""WITH RECURSIVE {_DUST} SELECT id, min(p) AS start, max(p) + 1 AS "end" FROM (SELECT id, p, p - row_number() OVER (PARTITION BY id ORDER BY p) AS g FROM f) GROUP BY id, g""")
def low_complexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intervals of customers' histories of order states that repeat too few triplets."""
    states = F.sort_array(F.collect_list(F.struct("o_orderdate", "o_orderkey", "o_orderstatus")))  # of one customer
    histories = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.concat_ws("", F.transform(states, lambda o: o["o_orderstatus"])).alias("seq"))
    return similarity.low_complexity(histories.select(F.col("o_custkey").alias("id"), "seq"))


@query("similar_by_hits", "SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS qseqid FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_discount * 1000 >= 90 AND l_quantity >= 0.8 * 40 AND o_totalprice > 0")
def similar_by_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as hits of orders: discount stands for identity, quantity for length, 40 for the query's length."""
    hits = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("qseqid"), (F.col("l_discount") * 1000).alias("pident"), F.col("l_quantity").alias("length"))
    lengths = read(spark, sf_dir, "orders").filter("o_totalprice > 0").select(F.col("o_orderkey").cast("string").alias("qseqid"), F.lit(40).alias("qlen"))
    return similarity.similar_by_hits(hits, lengths)


# --- samples -----------------------------------------------------------------------------------------


@query("cap_sample", f"WITH {_READS} SELECT read_id FROM r ORDER BY md5('42:' || read_id), read_id LIMIT 1000")
def cap_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.cap(reads_of(spark, sf_dir).select("read_id"), 1000, SEED)


def accessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("accession"), F.col("o_orderpriority").alias("category"), F.date_format("o_orderdate", "yyyy/MM/dd").alias("create_date"))


_RANKED = "SELECT o_orderkey AS accession, o_orderpriority AS category, row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5('42:' || o_orderkey), o_orderkey) AS rn FROM orders"


@query("stratified_sample", f"SELECT accession, category FROM ({_RANKED}) WHERE rn <= CASE category WHEN '1-URGENT' THEN 100 WHEN '2-HIGH' THEN 50 ELSE 1000000000 END")
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.stratified(accessions(spark, sf_dir), {"1-URGENT": 100, "2-HIGH": 50}, SEED).select("accession", "category")


@query("prefer_unseen_sample", """WITH s AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_quantity > 10), k AS (SELECT o_orderkey AS accession, o_orderpriority AS category, CASE WHEN l_orderkey IS NULL THEN 0 ELSE 1 END AS seen FROM orders LEFT JOIN s ON l_orderkey = o_orderkey),
    n AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY seen, md5('42:' || accession), accession) AS rn FROM k) SELECT accession, category, seen FROM n WHERE rn <= 200""")
def prefer_unseen_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = read(spark, sf_dir, "lineitem").filter("l_quantity > 10").select(F.col("l_orderkey").alias("accession"))
    return sampling.prefer_unseen(accessions(spark, sf_dir), seen, 200, SEED).select("accession", "category", "seen")


# --- catalogs and dates ----------------------------------------------------------------------------


@query("temporal_split", "SELECT o_orderkey AS accession, strftime(o_orderdate, '%Y/%m/%d') < '1999/01/01' AS is_train FROM orders")
def temporal_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temporal.with_split(accessions(spark, sf_dir), "1999-01-01").select("accession", "is_train")


@query("temporal_preview", """SELECT coalesce(o_orderpriority, 'total') AS category, count(*) AS n, count(*) FILTER (o_orderdate < '1999-01-01') AS n_train, count(*) FILTER (o_orderdate >= '1999-01-01') AS n_test,
    count(*) FILTER (o_orderdate < '1999-01-01') * 100.0 / count(*)::DOUBLE AS train_percent, count(*) FILTER (o_orderdate >= '1999-01-01') * 100.0 / count(*)::DOUBLE AS test_percent FROM orders GROUP BY ROLLUP (o_orderpriority)""")
def temporal_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temporal.preview(accessions(spark, sf_dir), "1999-01-01")


_CUTOFFS = """dt AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n, count(*) FILTER (o_orderpriority = '1-URGENT') AS u FROM orders GROUP BY 1),
    cu AS (SELECT d, sum(n) OVER () AS total, sum(u) OVER () AS total_u, sum(n) OVER w AS test_all, sum(u) OVER w AS test_0 FROM dt WINDOW w AS (ORDER BY d ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


@query("temporal_cutoff_counts", f"WITH {_CUTOFFS} SELECT strftime(d, '%Y-%m-%d') AS cutoff, CAST(total - test_all AS BIGINT) AS train_all, CAST(total_u - test_0 AS BIGINT) AS train_0, CAST(test_all AS BIGINT) AS test_all, CAST(test_0 AS BIGINT) AS test_0 FROM cu")
def temporal_cutoff_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temporal.cutoff_counts(accessions(spark, sf_dir), ["1-URGENT"])


@query("temporal_cutoff_search", f"WITH {_CUTOFFS} SELECT strftime(d, '%Y-%m-%d') AS cutoff, CAST(total - test_all AS BIGINT) AS train_all, CAST(total_u - test_0 AS BIGINT) AS train_0, CAST(test_all AS BIGINT) AS test_all, CAST(test_0 AS BIGINT) AS test_0 FROM cu WHERE total - test_all >= 300 AND test_all >= 200 AND test_0 >= 40 ORDER BY d DESC LIMIT 1")
def temporal_cutoff_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temporal.search_cutoff(accessions(spark, sf_dir), ["1-URGENT"], 300, 200, min_test_of={"1-URGENT": 40})


@query("catalog_metadata_merge", """WITH c AS (SELECT o_custkey AS accession, o_orderkey AS pos, strftime(o_orderdate, '%Y/%m/%d') AS create_date, o_orderstatus AS title, CAST(substr(o_orderpriority, 1, 1) AS INT) AS ord FROM orders),
    m AS (SELECT *, row_number() OVER (PARTITION BY accession ORDER BY ord DESC, pos DESC) AS rn FROM c) SELECT c_custkey AS accession, coalesce(create_date, '') AS create_date, coalesce(title, '') AS title FROM customer LEFT JOIN (SELECT * FROM m WHERE rn = 1) ON accession = c_custkey""")
def catalog_metadata_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders")
    catalog = orders.select(F.col("o_custkey").alias("accession"), F.date_format("o_orderdate", "yyyy/MM/dd").alias("create_date"), F.col("o_orderstatus").alias("title"), F.substring("o_orderpriority", 1, 1).cast("int").alias("category_order"), F.col("o_orderkey").alias("pos"))
    wanted = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("accession"))
    empty = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return wanted.join(temporal.merge_metadata(catalog), "accession", "left").select("accession", empty("create_date"), empty("title"))


@query("catalog_distinct_first", "SELECT o_custkey AS accession, min(o_orderkey) AS pos FROM orders GROUP BY 1")
def catalog_distinct_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("accession"), F.lit(0).alias("category_order"), F.col("o_orderkey").alias("pos"))
    return temporal.first_of_each(catalog).select("accession", F.col("first.pos").alias("pos"))


@query("cache_missing", "SELECT o_orderkey AS accession FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 25)")
def cache_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cached = read(spark, sf_dir, "lineitem").filter("l_quantity > 25").select(F.col("l_orderkey").alias("accession"))
    return lookup.missing(accessions(spark, sf_dir), cached)


@query("taxonomy_lineage", """SELECT c_custkey AS accession, coalesce(CASE WHEN n_nationkey % 2 = 0 THEN r_name ELSE r_name || ' order' END, 'unknown') AS "group" FROM customer
    LEFT JOIN nation ON n_nationkey = c_nationkey AND n_nationkey % 5 <> 0 LEFT JOIN region ON r_regionkey = n_regionkey""")
def taxonomy_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two lookups; every second nation has no family, and its order stands in."""
    customer, nation, region = (read(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    keyed = customer.select(F.col("c_custkey").alias("accession"), F.col("c_nationkey").alias("taxid"))
    known = nation.filter("n_nationkey % 5 <> 0").join(region, nation.n_regionkey == region.r_regionkey)
    orders = known.select(F.col("n_nationkey").alias("taxid"), F.lit("order").alias("rank"), F.concat("r_name", F.lit(" order")).alias("name"))
    families = known.filter("n_nationkey % 2 = 0").select(F.col("n_nationkey").alias("taxid"), F.lit("family").alias("rank"), F.col("r_name").alias("name"))
    return lookup.accession_groups(keyed.select("accession"), keyed, lookup.lineage_group(orders.unionByName(families), "family"))


@query("unknown_groups", "SELECT count(*) AS n, count(*) FILTER (c_nationkey % 5 = 0) AS n_unknown FROM customer")
def unknown_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxonomy_lineage(spark, sf_dir).agg(F.count("*").alias("n"), F.count_if(F.col("group") == "unknown").alias("n_unknown"))


@query("concat_reference", "SELECT conv_id || '_' || (row_number() OVER (ORDER BY conv_id, turn) - 1) || '_' || role AS name, text AS seq FROM conversations")
def concat_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read(spark, sf_dir, "conversations").select(F.col("conv_id").alias("genome_id"), F.col("turn").alias("record_idx"), F.col("role").alias("record_id"), F.col("text").alias("seq"))
    return lookup.concatenated(records)


_ONE_RECORD = "one AS (SELECT CAST(item_id AS VARCHAR) AS name, text FROM benchmark)"


@query("concat_lengths", f"WITH {_ONE_RECORD} SELECT name, length(text) AS length FROM one")
def concat_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lengths beside a reference of one record a genome."""
    records = read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("genome_id"), F.lit(0).alias("record_idx"), F.col("text").alias("seq"))
    return lookup.concatenated_with_lengths(records)[1]


@query("catalog_search", """SELECT o_orderkey AS accession, CASE o_orderstatus WHEN 'O' THEN 'bacteria' ELSE 'virus' END AS category FROM orders
    WHERE o_orderpriority = '1-URGENT' AND o_totalprice BETWEEN CASE o_orderstatus WHEN 'O' THEN 10000 ELSE 5000 END AND CASE o_orderstatus WHEN 'O' THEN 5000000 ELSE 500000 END AND o_custkey % 3 = 0""")
def catalog_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Default searches over orders as a catalog: the price stands for the length, the first priority for a complete genome."""
    category = F.when(F.col("o_orderstatus") == "O", "bacteria").otherwise("virus")
    title = F.when(F.col("o_orderpriority") == "1-URGENT", "A Complete Genome").otherwise("contig")
    catalog = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("accession"), category.alias("category"), title.alias("title"), (F.col("o_custkey") % 3 == 0).alias("refseq"), F.col("o_totalprice").alias("length"))
    return remote.search(catalog, "bacteria").unionByName(remote.search(catalog, "virus")).select("accession", "category")


@query("extra_pool_union", f"""WITH {_READS}, x AS (SELECT 'extra_viral_' || item_id AS gid, text, length(text) // 50 AS k FROM benchmark), e AS (SELECT gid || '_read_' || i AS read_id, substr(text, CAST(i * 50 + 1 AS BIGINT), 50) AS seq FROM (SELECT *, unnest(range(0, k)) AS i FROM x WHERE k > 0))
    SELECT read_id, seq FROM r UNION ALL SELECT read_id, seq FROM e""")
def extra_pool_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    pool = read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("record_idx"), F.col("text").alias("seq"))
    return reads_of(spark, sf_dir).select("read_id", "seq").unionByName(chunking.extra_pool(pool, 50).select("read_id", "seq"))


# --- perturbation and scores ------------------------------------------------------------------------


def dna_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A made-up sequence for each part: md5 of its key, as bases."""
    part = read(spark, sf_dir, "part")
    return part.select(F.concat(F.lit("p"), F.col("p_partkey")).alias("read_id"), F.translate(F.md5(F.col("p_partkey").cast("string").cast("binary")), "0123456789abcdef", "ACGTACGTACGTACGN").alias("seq"))


_DNA = "dna AS (SELECT 'p' || p_partkey AS read_id, translate(md5(p_partkey::VARCHAR), '0123456789abcdef', 'ACGTACGTACGTACGN') AS seq FROM part), bases AS (SELECT read_id, i, substr(seq, CAST(i + 1 AS BIGINT), 1) AS c FROM (SELECT *, unnest(range(0, 32)) AS i FROM dna))"
_D = lambda stream: _U(f"'42:' || read_id || ':' || i || ':{stream}'")
_OTHER = f"substr(replace('ACGT', c, ''), CAST(floor({_D('base')} * 3) + 1 AS BIGINT), 1)"


@query("illumina_errors", f"WITH {_DNA} SELECT read_id, string_agg(CASE WHEN c IN ('A', 'C', 'G', 'T') AND {_D('err')} < 0.05 + (0.3 - 0.05) * i / 31 THEN {_OTHER} ELSE c END, '' ORDER BY i) AS seq FROM bases GROUP BY read_id")
def illumina_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perturb.illumina_errors(dna_reads(spark, sf_dir), SEED, 0.05, 0.3)


@query("mutate_reads", f"""WITH {_DNA}, o AS (SELECT read_id, i, CASE WHEN c NOT IN ('A', 'C', 'G', 'T') THEN c WHEN {_D('indel')} < 0.2 AND {_D('kind')} >= 0.5 THEN '' ELSE
    CASE WHEN {_D('indel')} < 0.2 THEN substr('ACGT', CAST(floor({_D('ins')} * 4) + 1 AS BIGINT), 1) ELSE '' END || CASE WHEN {_D('sub')} < 0.1 THEN {_OTHER} ELSE c END END AS x FROM bases)
    SELECT read_id, string_agg(x, '' ORDER BY i) AS seq FROM o GROUP BY read_id""")
def mutate_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perturb.mutate(dna_reads(spark, sf_dir), 0.1, 0.2, SEED)


@query("phred_profile", "SELECT n AS length, i AS pos, CAST(least(41, greatest(0, round_even(-10 * log10(0.001 + (0.012 - 0.001) * i / greatest(1, n - 1)), 0))) AS INT) AS q FROM (SELECT n, unnest(range(0, n)) AS i FROM (SELECT DISTINCT p_size AS n FROM part))")
def phred_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read(spark, sf_dir, "part").select(F.col("p_size").alias("length")).distinct()
    reads = n.withColumn("seq", F.expr("repeat('A', length)"))
    return perturb.with_qualities(reads).select("length", F.posexplode("qual").alias("pos", "q")).select("length", F.col("pos").cast("long").alias("pos"), "q")


@query("score_filter", "SELECT doc_id AS read_id FROM documents WHERE length(text) >= 200 AND doc_id IN (SELECT doc_id FROM labels WHERE quality >= 0.5)")
def score_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    predictions = read(spark, sf_dir, "labels").select(F.col("doc_id").alias("name"), F.col("quality").cast("double").alias("score"))
    reads = genomes(spark, sf_dir).select(F.col("genome_id").alias("read_id"), "seq")
    return scoring.select_by_score(reads, predictions).select("read_id")


@query("plugged_scores", f"""WITH {_READS} SELECT read_id AS name, CASE WHEN gc / 250.0 >= 0.5 THEN 'phage' ELSE 'bacteria' END AS prediction, gc / 250.0::DOUBLE AS score FROM (SELECT read_id, 250 - length(replace(replace(replace(replace(seq, 'G', ''), 'C', ''), 'g', ''), 'c', '')) AS gc FROM r)""")
def plugged_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.predict(reads_of(spark, sf_dir))


@query("read_id_genomes", f"WITH {_READS} SELECT read_id, CAST(genome_id AS VARCHAR) AS genome FROM r")
def read_id_genomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads_of(spark, sf_dir).select("read_id", sq.genome_of_read("read_id").alias("genome"))


@query("category_of_path", "SELECT doc_id AS genome_id, CASE lang WHEN 'en' THEN 'virus' WHEN 'de' THEN 'bacteria' ELSE 'other' END AS category FROM documents")
def category_of_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = F.when(F.col("lang") == "en", "Virus").when(F.col("lang") == "de", "bacteria").otherwise(F.col("lang"))
    path = F.concat(F.lit("/data/"), folder, F.lit("/"), F.col("doc_id"), F.lit(".fasta"))
    return read(spark, sf_dir, "documents").select(F.col("doc_id").alias("genome_id"), sq.category_of_path(path).alias("category"))


@query("layout_counts", f"WITH {_G} SELECT count(*) FILTER (category = 'virus') AS viral, count(*) FILTER (category <> 'virus') AS other FROM g")
def layout_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = genomes(spark, sf_dir)
    lookup.check_layout(g)
    return g.agg(F.count_if(F.col("category") == "virus").alias("viral"), F.count_if(F.col("category") != "virus").alias("other"))


@query("fasta_lines", f"""WITH {_READS} SELECT '>' || read_id || ' start=' || "start" || ' end=' || "end" || chr(10) || seq AS value FROM r""")
def fasta_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.fasta_text(reads_of(spark, sf_dir), wrap=None)


@query("keyed_draws", f"SELECT p_partkey AS k, {_U(chr(39) + '7:' + chr(39) + ' || p_partkey')} AS u FROM part")
def keyed_draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), rng.draw(rng.key_of(7, "p_partkey")).alias("u"))

"""Whole plans: building a data set, splitting a catalog by date, replicates of a benchmark."""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom import rng
from readloom.functions.sequences import is_unambiguous
from readloom.operators import budgets, chunking, intervals, lookup, perturb, sampling, similarity, temporal
from readloom.progress import Callback, log, observed
from readloom.scratch import Scratch
from readloom.sources import sinks


@dataclass
class Recipe:
    """How reads are made of genomes; the same options as the command line's."""

    sequence_length: int = 250
    reads_per_genome: int | None = None
    min_length: int | None = None
    max_length: int | None = None
    seed: int | None = None
    cap_total: int | None = None
    forbid_ambiguous: bool = False
    substitution_rate: float = 0.0
    indel_rate: float = 0.0
    error_model: str | None = None
    fastq: bool = False
    abundance_profile: dict[str, float] | None = None
    abundance_distribution: str | None = None
    balanced: bool = False
    balance_by_taxonomy: bool = False
    filter_similar: bool = False
    similarity_threshold: float = 90.0
    min_coverage: float = 0.8
    similarity_batch: int | None = 500
    oversample: float = 2.0
    max_refill_rounds: int = 3
    both_strands: bool = True
    masks_keys: list[str] = field(default_factory=lambda: ["genome_id"])

    def check(self) -> None:
        if self.sequence_length < 1:
            raise ValueError("the sequence length must be at least 1")
        for name in ("reads_per_genome", "cap_total"):
            if (v := getattr(self, name)) is not None and v < 0:
                raise ValueError(f"{name} must not be negative")
        if (self.min_length is None) != (self.max_length is None):
            raise ValueError("give both min_length and max_length, or neither")
        if self.min_length is not None and not 1 <= self.min_length <= self.max_length:
            raise ValueError("lengths must satisfy 1 <= min_length <= max_length")
        for name in ("substitution_rate", "indel_rate"):
            if not 0 <= getattr(self, name) <= 1:
                raise ValueError(f"{name} must lie between 0 and 1")

    @property
    def perturbs(self) -> bool:
        return bool(self.error_model or self.fastq or self.substitution_rate or self.indel_rate)

    @property
    def seed_used(self) -> int:
        return 42 if self.seed is None else self.seed


def with_budgets(genomes: DataFrame, recipe: Recipe, taxonomy: DataFrame | None = None, base: int | None = None) -> DataFrame:
    """genomes with read_limit, base for each.  A profile beats a distribution, and taxonomy balancing replaces both."""
    limit = F.lit(base).cast("long")
    out = genomes.withColumn("read_limit", limit)
    if recipe.balanced:
        stats = budgets.balanced(budgets.genome_stats(genomes, recipe.sequence_length, recipe.min_length, recipe.max_length))
        out = genomes.join(stats.select("genome_id", "read_limit"), "genome_id")
    elif base is not None and recipe.abundance_profile:
        out = budgets.weighted(genomes, base, recipe.abundance_profile)
    elif base is not None and recipe.abundance_distribution == "exponential":
        out = budgets.exponential(genomes, base, recipe.seed_used)
    if recipe.balance_by_taxonomy:
        if taxonomy is None:
            raise ValueError("balancing by taxonomy needs a taxonomy")
        stats = budgets.genome_stats(genomes, recipe.sequence_length, recipe.min_length, recipe.max_length)
        known = stats.join(out.select("genome_id", "category", "read_limit"), "genome_id")
        limits = budgets.by_taxonomy(known, taxonomy).select("genome_id", "read_limit")
        out = out.drop("read_limit").join(limits, "genome_id")
    return out


def cut(genomes: DataFrame, recipe: Recipe) -> DataFrame:
    if recipe.min_length is not None:
        return chunking.variable_contigs(genomes, recipe.min_length, recipe.max_length, recipe.seed_used)
    return chunking.fixed_reads(genomes, recipe.sequence_length)


def _finished(reads: DataFrame, recipe: Recipe, masks: DataFrame | None) -> DataFrame:
    """Masks, the alphabet and errors, in that order: budgets have been applied before."""
    if masks is not None:
        reads = intervals.mask_reads(reads, masks, recipe.masks_keys)
    if recipe.forbid_ambiguous:
        reads = reads.filter(is_unambiguous("seq"))
    model = recipe.error_model or ("illumina" if recipe.fastq else None)
    return perturb.perturb(reads, error_model=model, substitution=recipe.substitution_rate, indel=recipe.indel_rate, seed=recipe.seed_used)


def build_dataset(genomes: DataFrame, recipe: Recipe, *, masks: DataFrame | None = None, taxonomy: DataFrame | None = None, extra: DataFrame | None = None) -> DataFrame:
    """The reads of a data set; genomes has genome_id, category, seq.

    With filter_similar and a target (a total cap, or reads per genome), candidates are oversampled, thinned by
    the ordered greedy choice and cut to the target.  Each genome then gives an equal share of the target times the
    oversampling factor, one read at least, or its own number if that is larger.  Budgets count candidate positions, so what a
    mask or the alphabet rejects is not replaced; an oversampled plan draws its spare reads from the
    genome's next positions, which keeps ids unique.
    """
    recipe.check()
    target = recipe.cap_total
    n_genomes = genomes.select("genome_id").distinct().count() if recipe.filter_similar else 0
    if recipe.filter_similar and target is None and recipe.reads_per_genome is not None:
        target = recipe.reads_per_genome * n_genomes
    filtering = recipe.filter_similar and target is not None
    if recipe.filter_similar and not filtering:
        warnings.warn("the similarity filter needs a total or a number of reads per genome; it is skipped", stacklevel=2)
    base = recipe.reads_per_genome
    if filtering and target > 0:
        base = max(base or 0, int(target * recipe.oversample) // max(1, n_genomes), 1)
    candidates = lambda base: _finished(cut(with_budgets(genomes, recipe, taxonomy, base), recipe), recipe, masks)
    reads = candidates(base)
    if extra is not None:
        pool = chunking.extra_pool(extra, recipe.sequence_length, recipe.reads_per_genome).withColumn("category", F.lit("virus"))
        pool = perturb.perturb(pool, error_model=recipe.error_model, substitution=recipe.substitution_rate, indel=recipe.indel_rate, seed=recipe.seed_used)
        shared = [c for c in reads.columns if c in pool.columns]
        reads = reads.select(*shared).unionByName(pool.select(*shared))
    if filtering:
        scratch = Scratch(genomes.sparkSession, "dataset")
        reads = scratch.save(reads, "reads")
        alike = {"identity": recipe.similarity_threshold, "coverage": recipe.min_coverage, "both_strands": recipe.both_strands}

        def thinned(reads: DataFrame) -> DataFrame:
            named = reads.withColumnRenamed("read_id", "id")
            ranked = named.withColumn("order", rng.order_key(recipe.seed_used, "id"))
            ranks = number(ranked.select("id", "order"), "order", "id")
            return similarity.greedy_choice(named, named.join(ranks, "id"), batch=recipe.similarity_batch, **alike)

        kept = scratch.save(thinned(reads).withColumn("round", F.lit(0)), "kept-0")
        n, seen, round_ = kept.count(), reads.select("read_id"), 0
        # Keys of what is kept are made once, and those of each round's additions added.
        index = similarity.KeyIndex(genomes.sparkSession, f"{scratch.path}/index")
        new = kept
        while n < target and round_ < recipe.max_refill_rounds:
            # The next unused positions: what a larger budget adds.
            round_ += 1
            index.add(new.select("id", "seq"))
            more = candidates((round_ + 1) * base).join(seen, "read_id", "left_anti").select(*reads.columns)
            more = scratch.save(more, f"more-{round_}")
            if more.isEmpty():
                break
            seen = seen.unionByName(more.select("read_id"))
            new = similarity.drop_similar(more.withColumnRenamed("read_id", "id"), index, **alike).withColumnRenamed("id", "read_id")
            new = scratch.save(thinned(scratch.save(new, f"new-{round_}")).withColumn("round", F.lit(round_)), f"added-{round_}")
            before, kept = n, scratch.save(kept.unionByName(new), f"kept-{round_}")
            n = kept.count()
            if n == before:
                break
        if n < target:
            warnings.warn(f"the data set is short of its target: {n} of {target} reads after {round_} refill rounds", stacklevel=2)
        place = F.concat(F.lpad(F.hex("round"), 4, "0"), F.lpad(F.hex("rank"), 16, "0"))
        reads = sampling.first_rows(kept, target, place, "id").drop("rank", "round").withColumnRenamed("id", "read_id")
    elif recipe.cap_total is not None:
        reads = sampling.cap(reads, recipe.cap_total, recipe.seed_used)
    return perturb.with_qualities(reads) if recipe.fastq else reads


def number(rows: DataFrame, order: str, tie: str) -> DataFrame:
    """rows with rank, from 0 in an order, without a sort in one task: ranks within hash prefixes and their sums."""
    from pyspark.sql import Window

    keyed = rows.withColumn("_prefix", F.substring(order, 1, 4))
    counts = keyed.groupBy("_prefix").agg(F.count("*").alias("_n"))  # at most 65,536 rows
    before = counts.withColumn("_before", F.sum("_n").over(Window.orderBy("_prefix")) - F.col("_n")).select("_prefix", "_before")
    own = F.row_number().over(Window.partitionBy("_prefix").orderBy(order, tie)) - 1
    return keyed.withColumn("_own", own).join(F.broadcast(before), "_prefix").select(tie, (F.col("_before") + F.col("_own")).alias("rank"))


def split_and_filter(reads: DataFrame, train_percent: float, recipe: Recipe, filter_test: bool = True) -> DataFrame:
    """reads with split; test reads similar to a train read are left out."""
    marked = sampling.train_test(reads, train_percent, recipe.seed_used)
    return drop_similar_test(marked, recipe) if filter_test else marked


def drop_similar_test(marked: DataFrame, recipe: Recipe) -> DataFrame:
    # Both sides are read several times: once made, they are kept.
    marked = Scratch(marked.sparkSession, "split").save(marked, "marked")
    side = lambda s: marked.filter(F.col("split") == s).withColumnRenamed("read_id", "id")
    kept = similarity.drop_similar(side("test"), side("train").select("id", "seq"), identity=recipe.similarity_threshold, coverage=recipe.min_coverage, both_strands=recipe.both_strands)
    return marked.filter(F.col("split") == "train").unionByName(kept.withColumnRenamed("id", "read_id").select(*marked.columns))


def temporal_datasets(genomes: DataFrame, dated: DataFrame, cutoff: str, recipe: Recipe, *, train_caps: dict[str, int], test_caps: dict[str, int], seeds: tuple[int, int] = (42, 43), masks: DataFrame | None = None) -> DataFrame:
    """Reads of a train and a test side by date, each sampled per category; similar test reads are left out.

    dated: accession, category, create_date; genomes' genome_id is an accession.
    """
    marked = temporal.with_split(dated, cutoff)
    chosen = sampling.stratified(marked.filter("is_train"), train_caps, seeds[0]).select("accession", F.lit("train").alias("split")).unionByName(
        sampling.stratified(marked.filter("not is_train"), test_caps, seeds[1]).select("accession", F.lit("test").alias("split"))
    )
    picked = genomes.join(chosen, F.col("genome_id") == F.col("accession")).drop("accession")
    reads = build_dataset(picked, recipe, masks=masks)
    return drop_similar_test(reads, recipe)


def benchmark_replicates(genomes: DataFrame, recipe: Recipe, *, per_category: int = 50, replicates: int = 5, attempts: int = 3, train_percent: float = 80, copy_to: str | None = None, progress: Callback = log) -> DataFrame:
    """Reads of several replicates, (replicate, split, ...), whose genomes differ as far as the catalog allows.

    With copy_to, each replicate's genomes are also written there, a file each under replicate_i/category, and must
    hold viral and other ones.

    Each replicate takes, of some attempts at a sample that prefers genomes not used before, the one with the
    fewest genomes similar to earlier replicates'.  All attempts of a replicate are scored in one job.
    """
    if per_category < 1 or replicates < 1 or attempts < 1 or not 0 <= train_percent <= 100:
        raise ValueError("per_category, replicates and attempts must be at least 1, and train_percent between 0 and 100")
    scratch = Scratch(genomes.sparkSession, "replicates")
    used, out = None, None
    index = similarity.KeyIndex(genomes.sparkSession, f"{scratch.path}/index")
    plain = genomes.select(F.col("genome_id").alias("accession"), "category")
    for i in range(replicates):
        tries = None
        for a in range(attempts):
            seen = plain.limit(0) if used is None else used
            one = sampling.prefer_unseen(plain, seen, per_category, recipe.seed_used + i + a * 10_000).select(F.lit(a).alias("attempt"), F.col("accession").alias("id"))
            tries = one if tries is None else tries.unionByName(one)
        tries = scratch.save(tries, f"tries-{i}")
        best = 0
        if used is not None:
            sequences = genomes.select(F.col("genome_id").alias("id"), "seq")
            scores = similarity.diversity_penalty(tries.join(sequences, "id"), index, identity=recipe.similarity_threshold, coverage=recipe.min_coverage, both_strands=recipe.both_strands)
            best = similarity.best_attempt(scores).first()["attempt"]
        chosen = tries.filter(F.col("attempt") == best).select(F.col("id").alias("accession"))
        new = chosen if used is None else chosen.join(used, "accession", "left_anti")
        index.add(genomes.join(new.select(F.col("accession").alias("genome_id")), "genome_id", "left_semi").select(F.col("genome_id").alias("id"), "seq"))
        used = scratch.save(chosen if used is None else used.unionByName(chosen).distinct(), f"used-{i}")
        wanted = chosen.select(F.col("accession").alias("genome_id"))
        picked = genomes.join(wanted, "genome_id", "left_semi")
        if copy_to is not None:
            lookup.check_layout(picked)
            sinks.copy_cached(wanted, genomes, f"{copy_to}/replicate_{i}")
        made, tell = observed(split_and_filter(build_dataset(picked, recipe), train_percent, recipe), f"replicate {i}", progress)
        reads = scratch.save(made, f"reads-{i}").withColumn("replicate", F.lit(i))
        tell()
        out = reads if out is None else out.unionByName(reads)
    return out

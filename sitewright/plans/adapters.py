"""Domain tables derived from the star-schema test tables.

Every rule is per row or a plain aggregate, so each adapter reads its whole table and
grows with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewright.session import BYTES_TO_BROADCAST, spread

TAXA = [f"t{i}" for i in range(8)]
REFERENCES = ["t0", "t1", "t2"]
SPAN = 50
MINREAD, THRESH, NUM_MISSING = 3, 0.6, 6


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fragments(li: DataFrame) -> DataFrame:
    """Line items as fragments of pileups: ``taxon, contig, pos, ref, reps, token`` besides their columns."""
    shift = "CASE WHEN l_partkey % 3 = 0 AND tn < 1 + l_partkey % 4 THEN 1 WHEN l_partkey % 5 = 0 AND tn = 6 THEN 2 ELSE 0 END"
    pick = f"CASE WHEN (l_orderkey * 31 + l_linenumber * 17) % 10 < 8 THEN (l_partkey + {shift}) % 5 ELSE (l_orderkey + l_linenumber) % 5 END"
    made = (
        li.withColumn("tn", F.expr("l_suppkey % 8"))
        .withColumn("letter", F.expr(f"substr('ACGT*', cast(1 + {pick} as int), 1)"))
        .withColumn("ref", F.expr("substr('ACGT', cast(1 + l_partkey % 4 as int), 1)"))
        .withColumn("reps", F.expr("cast(1 + l_linenumber % 3 as int)"))
    )
    token = F.expr(
        """CASE (l_orderkey * 7 + l_linenumber * 3) % 8
             WHEN 0 THEN CASE WHEN letter = ref THEN ',' ELSE letter END
             WHEN 1 THEN lower(letter)
             WHEN 2 THEN concat('^]', letter)
             WHEN 3 THEN concat(letter, '$')
             WHEN 4 THEN concat(letter, CASE WHEN l_linenumber % 2 = 0 THEN '+2AC' ELSE '+11ACGTACGTACG' END)
             WHEN 5 THEN concat(letter, '-1G')
             WHEN 6 THEN CASE WHEN letter = ref THEN '.' ELSE letter END
             ELSE concat('^+', letter) END"""
    )
    return made.select(
        "*", F.concat(F.lit("t"), "tn").alias("taxon"), F.expr(f"concat('c', l_partkey div {SPAN})").alias("contig"),
        F.expr(f"1 + l_partkey % {SPAN}").cast("bigint").alias("pos"), token.alias("token"),
    )


def pileup(spark, sf_dir) -> DataFrame:
    """Pileup rows: each line item is a fragment of a taxon's pileup at a site."""
    li = spread(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    made = fragments(li)
    return made.select(
        "taxon",
        "contig",
        "pos",
        "ref",
        F.col("reps").alias("depth"),
        F.repeat("token", F.col("reps")).alias("bases"),
        F.repeat(F.lit("I"), F.col("reps")).alias("quals"),
    )


def mixed_pileup(spark, sf_dir) -> DataFrame:
    """One pileup row per taxon and site: the fragments of all its line items, one after the other.

    Every 17th fragment is a reference skip or an unknown base, which the stated depth counts
    and decoding drops; at every 11th position the depth is stated one too high.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice")
    odd = "(l_orderkey * 5 + l_linenumber) % 17"
    skip = F.expr(f"CASE {odd} WHEN 0 THEN '<' WHEN 1 THEN 'N' WHEN 2 THEN '>' END")
    rows = fragments(li).withColumn("token", F.repeat(F.coalesce(skip, "token"), F.col("reps")))
    part = F.struct("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "token", "reps")
    sites = rows.groupBy("taxon", "contig", "pos", "ref").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    depth = F.aggregate("parts", F.lit(0), lambda n, x: n + x["reps"])
    return sites.select(
        "taxon", "contig", "pos", "ref",
        (depth + F.when(F.col("pos") % 11 == 0, 1).otherwise(0)).cast("int").alias("depth"),
        F.array_join(F.transform("parts", lambda x: x["token"]), "").alias("bases"),
        F.repeat(F.lit("I"), depth).alias("quals"),
    )


def pileup_lines(spark, sf_dir) -> DataFrame:
    """The same rows as text, ``(taxon, value)``."""
    fields = ["contig", "pos", "ref", "depth", "bases", "quals"]
    return pileup(spark, sf_dir).select("taxon", F.concat_ws("\t", *[F.col(f).cast("string") for f in fields]).alias("value"))


def sites(spark, sf_dir) -> DataFrame:
    """Site universe ``(contig_ord, contig, pos)``: one site per part."""
    part = table(spark, sf_dir, "part")
    return part.select(
        F.expr(f"p_partkey div {SPAN}").alias("contig_ord"),
        F.expr(f"concat('c', p_partkey div {SPAN})").alias("contig"),
        F.expr(f"1 + p_partkey % {SPAN}").cast("bigint").alias("pos"),
    )


def composite(spark, sf_dir) -> DataFrame:
    """Composite genome chunks: at most ``SPAN`` letters per contig."""
    part = table(spark, sf_dir, "part")
    letter = F.expr("substr('ACGT', cast(1 + p_partkey % 4 as int), 1)")
    members = F.sort_array(F.collect_list(F.struct("p_partkey", letter.alias("b"))))
    return (
        part.groupBy(F.expr(f"p_partkey div {SPAN}").alias("contig_ord"))
        .agg(members.alias("m"))
        .select(
            "contig_ord",
            F.concat(F.lit("c"), "contig_ord").alias("contig"),
            F.lit(0).cast("bigint").alias("offset"),
            F.array_join(F.col("m.b"), "").alias("seq"),
        )
    )


def fasta_pieces(spark, sf_dir) -> DataFrame:
    """Pieces of five FASTA files ``(file, start, data, fresh)``, a contig per part: its header, the first and the other letters of its one line."""
    p = table(spark, sf_dir, "part")
    first = F.expr("repeat(substr('ACGT', cast(1 + p_partkey % 4 as int), 1), p_size)")
    rest = F.expr("repeat(substr('TGNA', cast(1 + p_size % 4 as int), 1), cast(p_partkey % 37 as int))")
    texts = F.array(F.concat(F.lit(">k"), F.col("p_partkey"), F.lit(" "), F.col("p_name"), F.lit("\n")), first, F.concat(rest, F.lit("\n")))
    made = p.select(F.concat(F.lit("f"), F.col("p_partkey") % 5).alias("file"), "p_partkey", F.posexplode(texts).alias("at", "text"))
    return made.select("file", (F.col("p_partkey") * 1000 + F.col("at")).alias("start"), F.col("text").cast("binary").alias("data"), (F.col("at") < 2).alias("fresh"))


def _site_letters(spark, sf_dir, taxa: int) -> DataFrame:
    """``(contig_ord, t, letters, loci)``: a taxon's letters at the parts of each contig."""
    p = table(spark, sf_dir, "part")
    letter = "substr('ACGT-', cast(1 + (p_partkey * (t + 3) + p_size) % 5 as int), 1)"
    each = p.withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(taxa - 1))))
    members = F.sort_array(F.collect_list(F.struct("p_partkey", F.expr(letter).alias("b"))))
    locus = F.transform("m", lambda x: F.concat(F.lit("c"), F.expr("contig_ord"), F.lit("/"), (1 + x["p_partkey"] % SPAN).cast("string")))
    grouped = each.groupBy(F.expr(f"p_partkey div {SPAN}").alias("contig_ord"), "t").agg(members.alias("m"))
    return grouped.select("contig_ord", "t", F.array_join(F.col("m.b"), "").alias("letters"), F.array_join(locus, " ").alias("loci"))


def _piece(start, text, fresh) -> list:
    return [F.lit("a").alias("file"), start.cast("bigint").alias("start"), text.cast("binary").alias("data"), fresh.alias("fresh")]


def phylip_pieces(spark, sf_dir, taxa: int = 6) -> DataFrame:
    """Pieces of an interleaved PHYLIP file with names of ten letters: a block per contig, a line per taxon."""
    rows = _site_letters(spark, sf_dir, taxa)
    name = F.when(F.col("contig_ord") == 0, F.rpad(F.concat(F.lit("tax "), F.col("t")), 10, " ")).otherwise(F.lit(""))
    lines = rows.select(*_piece((F.col("contig_ord") + 1) * 1000 + F.col("t"), F.concat(name, "letters", F.lit("\n")), F.lit(True)))
    head = table(spark, sf_dir, "part").agg(F.concat(F.lit(f" {taxa} "), F.count("*"), F.lit("\n")).alias("text"))
    return lines.unionByName(head.select(*_piece(F.lit(0), F.col("text"), F.lit(True))))


def nexus_pieces(spark, sf_dir, taxa: int = 6) -> DataFrame:
    """Pieces of a NEXUS file: the list of loci and each taxon's letters are one line each, cut by contigs."""
    rows = _site_letters(spark, sf_dir, taxa)
    last = table(spark, sf_dir, "part").agg(F.expr(f"max(p_partkey) div {SPAN}")).scalar()
    ends = F.when(F.col("contig_ord") == last, F.lit("\n")).otherwise(F.lit(""))
    first = F.col("contig_ord") == 0
    letters = rows.select(*_piece((F.col("t") + 2) * 10**12 + F.col("contig_ord"), F.concat(F.when(first, F.concat(F.lit("t"), "t", F.lit("\t"))).otherwise(F.lit("")), "letters", ends), first))
    loci = rows.where("t = 0").select(*_piece(F.lit(10**12) + F.col("contig_ord"), F.concat(F.when(first, F.lit("[ ")).otherwise(F.lit("")), "loci", F.when(ends != "", F.lit(" ]\n")).otherwise(F.lit(" "))), first))
    around = rows.where("t = 0 and contig_ord = 0").select(F.explode(F.array(F.struct(F.lit(0).cast("bigint").alias("s"), F.lit("#NEXUS\n[a remark]\nBEGIN DATA;\n matrix\n").alias("x")), F.struct(F.lit(10**15).alias("s"), F.lit(";\nend;\n[more]\nt9\tACGT\n").alias("x")))).alias("e"))
    return letters.unionByName(loci).unionByName(around.select(*_piece(F.col("e.s"), F.col("e.x"), F.lit(True))))


def contig_table(spark, sf_dir) -> DataFrame:
    """Contigs with a length of 1 to 50 bases, one per part."""
    part = table(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").alias("contig_ord"), F.concat_ws(" ", F.concat(F.lit("k"), "p_partkey"), "p_name").alias("contig"),
        F.col("p_size").cast("bigint").alias("length"),
    )


def map_rows(spark, sf_dir) -> DataFrame:
    """Genome map rows with clips, indels and all three kinds of direction."""
    needed = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_linestatus"]
    li = spread(table(spark, sf_dir, "lineitem").select(needed))
    return li.select(
        F.expr("concat('q', l_orderkey, '_', l_linenumber)").alias("contig"),
        F.expr("concat('chr', l_suppkey % 5)").alias("chrom"),
        F.expr("1 + l_orderkey * 10 + l_linenumber * 3").cast("bigint").alias("start"),
        F.expr("CASE WHEN l_partkey % 11 = 0 THEN 4 WHEN l_linestatus = 'O' THEN 0 ELSE 16 END").alias("direction"),
        F.expr(
            "concat(l_linenumber, 'S', 1 + cast(l_quantity as int) % 4, 'M', 1 + l_linenumber % 3, 'D',"
            " l_linenumber, 'I', 1 + l_orderkey % 3, 'M')"
        ).alias("cigar"),
    )


def sam_rows(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", F.expr("cast(l_partkey % 32 as int)").alias("flag"))


def aligned_reads(spark, sf_dir) -> DataFrame:
    """Reads ``(read, contig, start, flag, mapq, cigar, seq)``, one per line item, with clips, insertions and deletions on both strands."""
    li = spread(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"))
    sizes = li.selectExpr("*", "l_linenumber % 3 AS clip", "4 + l_linenumber % 3 AS first", "1 + l_orderkey % 2 AS more", "1 + l_suppkey % 2 AS less")
    cigar = F.expr("concat(CASE WHEN clip > 0 THEN concat(clip, 'S') ELSE '' END, first, 'M', more, 'I3M', less, 'D4M')")
    letter = "substr('ACGT', cast(1 + (l_orderkey + {} * l_linenumber) % 4 AS int), 1)"
    four = "concat(" + ", ".join(letter.format(q) for q in range(4)) + ")"  # letters come again after four while no remainder is negative
    again = f"substr(repeat({four}, cast((clip + first + more + 10) div 4 AS int)), 1, cast(clip + first + more + 7 AS int))"
    each = f"array_join(transform(sequence(0, cast(clip + first + more + 6 AS int)), q -> {letter.format('q')}), '')"
    letters = F.expr(f"CASE WHEN l_orderkey >= 0 AND l_linenumber >= 0 THEN {again} ELSE {each} END")
    return sizes.select(
        F.expr("concat(lpad(l_orderkey, 12, '0'), '_', l_linenumber, '_', lpad(l_suppkey, 8, '0'), '_', lpad(cast(l_quantity AS int), 3, '0'))").alias("read"),
        F.expr(f"concat('c', l_partkey div {SPAN})").alias("contig"), F.expr("1 + l_partkey % 30").alias("start"),
        F.expr("CASE WHEN l_quantity = 7 THEN 4 WHEN l_linenumber % 2 = 0 THEN 16 ELSE 0 END").alias("flag"),
        F.expr("cast(l_quantity AS int)").alias("mapq"), cigar.alias("cigar"), letters.alias("seq"),
    )


def manifest_rows(spark, sf_dir) -> DataFrame:
    """Raw manifest rows with empty ids, groups and reads among them."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.expr("CASE WHEN c_custkey % 97 <> 5 THEN c_name END").alias("sample_id"),
        F.expr("CASE WHEN c_nationkey <> 0 THEN c_mktsegment END").alias("grp"),
        F.expr("CASE WHEN c_nationkey % 7 <> 3 THEN concat('/reads/', c_custkey, '_1.fastq.gz') END").alias("forward"),
        F.expr("CASE WHEN c_acctbal >= 0 THEN concat('/reads/', c_custkey, '_2.fastq.gz') END").alias("reverse"),
    )


def read_files(spark, sf_dir) -> DataFrame:
    """Read files ``(grp, path)``: forward, reverse and single ones, some undetermined."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderpriority").alias("grp"),
        F.expr(
            "concat('/reads/', o_orderpriority, '/', CASE WHEN o_custkey % 50 = 0 THEN 'Undetermined_' ELSE '' END, 'S',"
            " o_custkey, CASE o_orderstatus WHEN 'F' THEN '_1.fastq.gz' WHEN 'O' THEN '_2.fastq.gz' ELSE '.fastq.gz' END)"
        ).alias("path"),
    ).distinct()


def sample_stats(spark, sf_dir) -> DataFrame:
    """Base counts per sample: whole cents of a customer's orders."""
    o = table(spark, sf_dir, "orders")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return o.groupBy(F.col("o_custkey").alias("sample_id")).agg(
        F.count("*").cast("bigint").alias("read_count"), F.sum(cents).cast("bigint").alias("base_count")
    )


def sample_groups(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("sample_id"), F.expr("CASE WHEN c_custkey % 20 = 0 THEN 'SMALL' ELSE c_mktsegment END").alias("grp")
    )


def assemblies(spark, sf_dir) -> DataFrame:
    """Contigs ``(path, length)`` of one assembly per source and language."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.concat(F.lit("/asm/"), "source", F.lit("."), "lang", F.lit("_trim.fasta")).alias("path"), F.col("n_chars").alias("length")
    )


def triangle_lines(spark, sf_dir) -> DataFrame:
    """Lower triangle as text: the line of isolate i holds up to 64 whole-number distances."""
    e = table(spark, sf_dir, "embeddings")
    micro = F.transform("embedding", lambda x: F.round(F.abs(x.cast("double")) * 1000000).cast("bigint").cast("string"))
    part = F.slice(micro, 1, F.least(F.col("vec_id"), F.size(micro)).cast("int"))
    path = F.concat(F.lit("/asm/iso"), "vec_id", F.lit("_trim.fasta"))
    return e.select(
        (F.col("vec_id") + 1).alias("line_no"), F.concat_ws("\t", F.array_insert(part, 1, path)).alias("value")
    )


def edges(spark, sf_dir) -> DataFrame:
    """Distances ``(id_a, id_b, dist)`` between isolates and up to 64 earlier ones."""
    e = table(spark, sf_dir, "embeddings")
    cells = e.select(F.col("vec_id").alias("id_a"), F.posexplode("embedding").alias("id_b", "x"))
    return cells.filter(F.col("id_b") < F.col("id_a")).select(
        "id_a", F.col("id_b").cast("bigint").alias("id_b"), F.round(F.abs(F.col("x").cast("double")) * 1000000).alias("dist")
    )


def groups(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").alias("grp"))


def vector_rows(spark, sf_dir) -> DataFrame:
    """Distance rows of the isolates to 64 landmarks."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("features")
    )


def full_edges(spark, sf_dir) -> DataFrame:
    """The complete lower triangle of distances between the suppliers' isolates, in three groups far apart."""
    ids = spread(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id_a")))
    others = ids.withColumnRenamed("id_a", "id_b")
    pairs = ids.join(F.broadcast(others) if 8 * others.count() <= BYTES_TO_BROADCAST else others, F.expr("id_b < id_a"))
    far = F.when(F.col("id_a") % 3 == F.col("id_b") % 3, F.lit(1000.0)).otherwise(F.lit(100000.0))
    return pairs.withColumn("dist", far + (F.col("id_a") * 7919 + F.col("id_b") * 104729) % 101)


def separated_rows(spark, sf_dir, groups: int, dims: int) -> DataFrame:
    """Rows in well separated groups: the label decides the corner, the vector's lower digits the place around it.

    Six uniform digits are added up for each dimension, which is near to a normal spread.
    """
    e = table(spark, sf_dir, "embeddings")
    digits = F.transform("embedding", lambda x: F.abs(x.cast("double")) * 10000 % 1)
    around = [sum((F.get(digits, F.lit(6 * d + i)) for i in range(6)), F.lit(-3.0)) for d in range(dims)]
    corner = F.col("label") % groups
    return e.select(F.col("vec_id").alias("id"), F.array(*[F.when(corner % dims == d, F.lit(20.0) * (1 + F.floor(corner / dims))).otherwise(0.0) + a for d, a in enumerate(around)]).alias("features"))


def wide_rows(spark, sf_dir, groups: int = 3) -> DataFrame:
    """Rows of 64 dimensions in well separated groups: the label decides which dimensions lie high."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("id"), F.transform("embedding", lambda x, i: x.cast("double") + F.when(i % groups == F.col("label") % groups, 6.0).otherwise(0.0)).alias("features"))


def isolates(spark, sf_dir) -> DataFrame:
    """Isolates ``(id, path, ord)``: one per supplier."""
    s = table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey")
    return s.select(key.alias("id"), F.concat(F.lit("/asm/iso"), key, F.lit(".fasta")).alias("path"), key.alias("ord"))


def isolate_contigs(spark, sf_dir) -> DataFrame:
    """Contigs ``(path, length)`` of the isolates: one per line item."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat(F.lit("/asm/iso"), "l_suppkey", F.lit(".fasta")).alias("path"),
        F.expr("cast(l_quantity as bigint) * 37 + l_linenumber").alias("length"),
    )


def log_lines(spark, sf_dir) -> DataFrame:
    """Log lines ``(taxon, line_no, line)``: the lines of each document."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.concat(F.lit("d"), "doc_id").alias("taxon"), F.posexplode_outer(F.split("text", "\n")).alias("line_no", "line"))

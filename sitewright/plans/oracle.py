"""Independent SQL for the registered queries.

The SQL knows what each adapter encodes and works on that directly: votes come from the
letters behind the pileup strings, alleles from exploded rows, paths from text functions.
It shares no expression with the DataFrame code.
"""

from __future__ import annotations

SQL: dict[str, str] = {}


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


LETTERS = """letters AS (
  SELECT l_suppkey % 8 AS tn, 't' || (l_suppkey % 8) AS taxon, l_partkey AS p,
         'c' || (l_partkey // 50) AS contig, CAST(1 + l_partkey % 50 AS BIGINT) AS pos,
         1 + l_linenumber % 3 AS reps, l_orderkey AS ok, l_linenumber AS ln,
         substr('ACGT', CAST(1 + l_partkey % 4 AS INT), 1) AS ref,
         substr('ACGT*', CAST(1 + CASE
            WHEN (l_orderkey * 31 + l_linenumber * 17) % 10 >= 8 THEN (l_orderkey + l_linenumber) % 5
            WHEN l_partkey % 3 = 0 AND l_suppkey % 8 < 1 + l_partkey % 4 THEN (l_partkey + 1) % 5
            WHEN l_partkey % 5 = 0 AND l_suppkey % 8 = 6 THEN (l_partkey + 2) % 5
            ELSE l_partkey % 5 END AS INT), 1) AS letter
  FROM lineitem)"""
VOTES = LETTERS + """, votes AS (
  SELECT taxon, contig, pos, letter, SUM(reps) AS n FROM letters GROUP BY ALL),
tops AS (
  SELECT taxon, contig, pos, SUM(n) AS total, MAX(n) AS top, arg_max(letter, n) AS winner FROM votes GROUP BY ALL)"""
CALLS = VOTES + """, calls AS (
  SELECT taxon, contig, pos,
         CASE WHEN top < 3 OR top / total < 0.6 THEN 'N' WHEN winner = '*' THEN '-' ELSE winner END AS base,
         CASE WHEN top < 3 AND top / total < 0.6 THEN 'both' WHEN top < 3 THEN 'min'
              WHEN top / total < 0.6 THEN 'thresh' END AS penalty
  FROM tops)"""
MAJORITY = VOTES + """, best AS (
  SELECT v.taxon, v.contig, v.pos, v.letter,
         row_number() OVER (PARTITION BY v.taxon, v.contig, v.pos ORDER BY v.n DESC, (v.letter = '*'), v.letter) AS rk
  FROM votes v),
majority AS (SELECT taxon, contig, pos, CASE WHEN letter = '*' THEN 'N' ELSE letter END AS base FROM best WHERE rk = 1)"""
UNIVERSE = """universe AS (
  SELECT p_partkey AS p, p_partkey // 50 AS contig_ord, 'c' || (p_partkey // 50) AS contig,
         CAST(1 + p_partkey % 50 AS BIGINT) AS pos FROM part)"""
TAXA = "taxa AS (SELECT i, 't' || i AS taxon FROM range(8) r(i))"
ALLELES = CALLS + """, alleles AS (
  SELECT contig, pos, base, COUNT(*) AS n FROM calls WHERE base <> 'N' GROUP BY ALL),
classes AS (
  SELECT contig, pos, SUM(n) AS called, COUNT(*) AS n_alleles, COUNT(*) FILTER (n = 1) AS ones,
         COALESCE(SUM(n) FILTER (base = '-'), 0) AS gaps
  FROM alleles GROUP BY contig, pos HAVING 8 - SUM(n) <= 6 AND COUNT(*) > 1),
labelled AS (
  SELECT *, CASE WHEN ones >= n_alleles - 1 THEN 'singleton' WHEN ones > 0 THEN 'othersingle' ELSE 'informative' END AS site_class,
         ones = 0 AND n_alleles = 2 AS biallelic FROM classes)"""
GRID = ALLELES + ", " + TAXA + """, grid AS (
  SELECT l.contig, l.pos, t.i, t.taxon, COALESCE(c.base, 'N') AS base, l.site_class, l.biallelic, l.called, l.gaps
  FROM labelled l CROSS JOIN taxa t LEFT JOIN calls c ON c.contig = l.contig AND c.pos = l.pos AND c.taxon = t.taxon),
cols AS (
  SELECT contig, pos, string_agg(base, '' ORDER BY i) AS "column", any_value(site_class) AS site_class,
         any_value(biallelic) AS biallelic, any_value(called) AS called, any_value(gaps) AS gaps
  FROM grid GROUP BY contig, pos)"""

SQL["pileup_scan"] = _with(
    LETTERS,
    """SELECT taxon, contig, pos, ref, CAST(reps AS INT) AS depth, repeat('I', CAST(reps AS INT)) AS quals,
       repeat(CASE (ok * 7 + ln * 3) % 8
         WHEN 0 THEN CASE WHEN letter = ref THEN ',' ELSE letter END WHEN 1 THEN lower(letter) WHEN 2 THEN '^]' || letter
         WHEN 3 THEN letter || '$' WHEN 4 THEN letter || CASE WHEN ln % 2 = 0 THEN '+2AC' ELSE '+11ACGTACGTACG' END
         WHEN 5 THEN letter || '-1G' WHEN 6 THEN CASE WHEN letter = ref THEN '.' ELSE letter END
         ELSE '^+' || letter END, CAST(reps AS INT)) AS bases FROM letters""",
)
SQL["pileup_decode"] = _with(
    LETTERS,
    "SELECT taxon, contig, pos, CAST(reps AS INT) AS depth, repeat(letter, CAST(reps AS INT)) AS decoded FROM letters",
)
MIXED = LETTERS.replace("FROM lineitem", ", l_quantity AS q, l_extendedprice AS e, (l_orderkey * 5 + l_linenumber) % 17 < 3 AS dropped FROM lineitem") + """, mixed AS (
  SELECT taxon, contig, pos, CAST(SUM(reps) + CASE WHEN pos % 11 = 0 THEN 1 ELSE 0 END AS INT) AS depth,
         COALESCE(string_agg(repeat(letter, CAST(reps AS INT)), '' ORDER BY ok, ln, q, e) FILTER (NOT dropped), '') AS decoded
  FROM letters GROUP BY taxon, contig, pos),
counted AS (
  SELECT taxon, contig, pos, b, len(decoded) - len(replace(decoded, b, '')) AS n, instr(decoded, b) AS first
  FROM mixed, (SELECT unnest(['A', 'C', 'G', 'T', '*']) AS b))"""
RANKED = MIXED + """, ranked AS (
  SELECT *, SUM(n) OVER site AS total, row_number() OVER (PARTITION BY taxon, contig, pos ORDER BY n DESC, first) AS seen,
         row_number() OVER (PARTITION BY taxon, contig, pos ORDER BY n DESC, b = '*', b) AS ordered
  FROM counted WINDOW site AS (PARTITION BY taxon, contig, pos))"""


def _called(least: int, share: float) -> str:
    few, short = f"n < {least}", f"(total > 0 AND n / total < {share})"
    return f"""SELECT taxon, contig, pos, CASE WHEN {few} OR {short} OR total = 0 THEN 'N' WHEN b = '*' THEN '-' ELSE b END AS base,
      CASE WHEN {few} AND {short} THEN 'both' WHEN {few} THEN 'min' WHEN {short} THEN 'thresh' END AS penalty FROM ranked WHERE seen = 1"""


SQL["depth_mismatches"] = _with(MIXED, "SELECT taxon, COUNT(*) AS n_rows FROM mixed WHERE len(decoded) <> depth GROUP BY taxon")
SQL["mixed_decode"] = _with(MIXED, "SELECT * FROM mixed")
SQL["site_calls"] = _with(RANKED, _called(3, 0.8))
SQL["site_calls_half"] = _with(RANKED, _called(1, 0.5))
SQL["site_majority"] = _with(RANKED, "SELECT taxon, contig, pos, CASE WHEN b = '*' THEN 'N' ELSE b END AS base FROM ranked WHERE ordered = 1 AND n > 0")
SQL["base_votes"] = _with(
    LETTERS,
    """SELECT taxon, contig, pos, """
    + ", ".join(
        f"CAST(COALESCE(SUM(reps) FILTER (letter = '{b}'), 0) AS BIGINT) AS n_{'del' if b == '*' else b.lower()}" for b in "ACGT*"
    )
    + " FROM letters GROUP BY taxon, contig, pos",
)
SQL["majority_consensus"] = _with(MAJORITY, "SELECT taxon, contig, pos, base FROM majority")
SQL["thresholded_calls"] = _with(CALLS, "SELECT taxon, contig, pos, base, penalty FROM calls")
SQL["call_vectors"] = _with(
    CALLS + ", " + UNIVERSE + ", " + TAXA,
    """SELECT t.taxon, u.contig, u.pos, COALESCE(c.base, 'N') AS base FROM universe u CROSS JOIN taxa t
       LEFT JOIN calls c ON c.contig = u.contig AND c.pos = u.pos AND c.taxon = t.taxon""",
)
_QC = CALLS + ", " + UNIVERSE + ", " + TAXA + """, vectors AS (
  SELECT t.taxon, COALESCE(c.base, 'N') AS base, c.penalty FROM universe u CROSS JOIN taxa t
  LEFT JOIN calls c ON c.contig = u.contig AND c.pos = u.pos AND c.taxon = t.taxon),
qc AS (
  SELECT taxon, COUNT(*) AS positions, COUNT(*) FILTER (base <> 'N') AS called, COUNT(*) FILTER (base = 'N') AS n_calls,
         COUNT(*) FILTER (penalty = 'thresh') AS lost_threshold, COUNT(*) FILTER (penalty = 'min') AS lost_coverage,
         COUNT(*) FILTER (penalty = 'both') AS lost_both, COUNT(*) FILTER (base = 'N' AND penalty IS NULL) AS no_data,
         printf('%.2f', COUNT(*) FILTER (base <> 'N') / COUNT(*) * 100) AS called_percent,
         printf('%.2f', COUNT(*) FILTER (base = 'N') / COUNT(*) * 100) AS n_percent
  FROM vectors GROUP BY taxon)"""
SQL["call_quality"] = _with(_QC, "SELECT * FROM qc")
SQL["contig_quality"] = SQL["call_quality"]
SQL["quality_lines"] = _with(
    _QC,
    """SELECT taxon, CAST(0 AS INT) AS line_no, 'Of ' || positions || ' positions, ' || taxon || ' has good calls for ' || called ||
         ' sites (' || called_percent || '%). There were ' || n_calls || ' N calls (' || n_percent || '%).' AS line FROM qc
       UNION ALL
       SELECT taxon, CAST(1 AS INT), 'Of ' || n_calls || ' Ns, ' || taxon || ' lost ' || lost_threshold ||
         ' via homozygosity threshold, ' || lost_coverage || ' from low coverage, and ' || lost_both || ' from both. ' ||
         no_data || ' sites had no pileup data.' FROM qc""",
)
SQL["taxon_genomes"] = _with(
    MAJORITY + ", " + UNIVERSE + ", " + TAXA,
    """SELECT t.taxon, u.contig, string_agg(COALESCE(m.base, substr('ACGT', CAST(1 + u.p % 4 AS INT), 1)), '' ORDER BY u.pos) AS seq
       FROM universe u CROSS JOIN taxa t LEFT JOIN majority m ON m.contig = u.contig AND m.pos = u.pos AND m.taxon = t.taxon
       GROUP BY t.taxon, u.contig""",
)
SQL["contig_lengths"] = "SELECT 'c' || (p_partkey // 50) AS contig, COUNT(*) AS length FROM part GROUP BY 1"
SQL["site_enumeration"] = """SELECT p_partkey AS contig_ord, 'PG_k' || p_partkey AS contig, x AS pos, 'PG_k' || p_partkey || '/' || x AS locus
  FROM (SELECT p_partkey, unnest(range(1, CAST(p_size AS BIGINT) + 1)) AS x FROM part)"""
SQL["renamed_contigs"] = (
    "SELECT p_partkey AS contig_ord, 'PG_k' || p_partkey AS contig, CAST(p_size AS BIGINT) AS length FROM part"
)
SQL["variable_sites"] = _with(
    GRID,
    """SELECT contig, pos, string_agg(base, '' ORDER BY i) AS "column", """
    + ", ".join(f"CAST(COUNT(*) FILTER (base = '{b}') AS INT) AS n_{'gap' if b == '-' else b.lower()}" for b in "ACGT-")
    + " FROM grid GROUP BY contig, pos",
)
SQL["site_classes"] = _with(
    GRID,
    """SELECT c.contig, c.pos, c."column", CAST(l.n_alleles AS INT) AS n_alleles, l.site_class, l.biallelic
       FROM cols c JOIN labelled l ON l.contig = c.contig AND l.pos = c.pos""",
)
SQL["site_class_counts"] = _with(ALLELES, "SELECT site_class, biallelic, COUNT(*) AS n_sites FROM labelled GROUP BY ALL")
_TOTALS = """totals AS (SELECT COUNT(*) AS variable_sites, COUNT(*) FILTER (site_class = 'singleton') AS singleton_sites,
  COUNT(*) FILTER (site_class = 'othersingle') AS with_singleton_sites,
  COUNT(*) FILTER (site_class = 'informative') AS informative_sites, COUNT(*) FILTER (biallelic) AS biallelic_sites FROM labelled)"""
SQL["class_totals"] = _with(ALLELES + ", " + _TOTALS, "SELECT * FROM totals")
SQL["class_report"] = _with(
    ALLELES + ", " + _TOTALS,
    "\nUNION ALL ".join(
        f"SELECT CAST({i} AS INT) AS line_no, {col} || ' {text}' AS line FROM totals"
        for i, (col, text) in enumerate(
            [
                ("variable_sites", "total variable sites [alignment.nex]"),
                ("singleton_sites", "variable sites are singletons [alignment_singletons.nex]"),
                ("with_singleton_sites", "variable sites contain singletons [alignment_pi_singletons.nex]"),
                ("informative_sites", "variable sites contain no singletons [alignment_pi.nex]"),
                ("biallelic_sites", "variable sites are biallelic without singletons [alignment_bi.nex]"),
            ]
        )
    ),
)
SQL["alignment_blocks"] = _with(
    GRID,
    "\nUNION ALL ".join(
        f"SELECT '{v}' AS variant, taxon, contig, string_agg(base, '' ORDER BY pos) AS seq FROM grid WHERE {cond} GROUP BY taxon, contig"
        for v, cond in [
            ("all", "TRUE"),
            ("bi", "biallelic"),
            ("pi", "site_class = 'informative'"),
            ("pi_singletons", "site_class IN ('informative', 'othersingle')"),
            ("singletons", "site_class = 'singleton'"),
        ]
    ),
)
SQL["nexus_document"] = _with(
    GRID + ", pi AS (SELECT * FROM grid WHERE site_class = 'informative')",
    """SELECT CAST(0 AS INT) AS section, '' AS contig, '#NEXUS' || chr(10) || chr(10) || 'BEGIN DATA;' || chr(10) || 'DIMENSIONS NTAX=8 NCHAR=' ||
         COUNT(*) // 8 || ';' || chr(10) || 'FORMAT MISSING=? GAP=- DATATYPE=DNA;' || chr(10) || 'MATRIX' || chr(10) || '[' AS text FROM pi
       UNION ALL SELECT CAST(1 AS INT), contig, string_agg(' ' || contig || '/' || pos, '' ORDER BY pos) FROM pi WHERE i = 0 GROUP BY contig
       UNION ALL SELECT CAST(2 AS INT), '', ' ]' || chr(10)
       UNION ALL SELECT CAST(10 + 3 * i AS INT), '', taxon || chr(9) FROM taxa
       UNION ALL SELECT CAST(11 + 3 * i AS INT), contig, string_agg(base, '' ORDER BY pos) FROM pi GROUP BY i, contig
       UNION ALL SELECT CAST(12 + 3 * i AS INT), '', chr(10) FROM taxa
       UNION ALL SELECT CAST(34 AS INT), '', ';' || chr(10) || 'end;'""",
)
SQL["phylip_document"] = _with(
    GRID + ", kept AS (SELECT * FROM grid WHERE called >= 6 AND gaps = 0)",
    """SELECT CAST(0 AS INT) AS section, '' AS contig, ' 8 ' || COUNT(*) // 8 || chr(10) AS text FROM kept
       UNION ALL SELECT CAST(10 + 3 * i AS INT), '', taxon || ' ' FROM taxa
       UNION ALL SELECT CAST(11 + 3 * i AS INT), contig, string_agg(base, '' ORDER BY pos) FROM kept GROUP BY i, contig
       UNION ALL SELECT CAST(12 + 3 * i AS INT), '', chr(10) FROM taxa""",
)
SQL["missing_refilter"] = _with(GRID, 'SELECT contig, pos, "column", gaps = 0 AS gapless FROM cols WHERE called >= 6')
SQL["missing_report"] = _with(
    ALLELES + """, sums AS (SELECT COUNT(*) AS before, COUNT(*) FILTER (called >= 6) AS gap,
      COUNT(*) FILTER (called >= 6 AND gaps = 0) AS nogap FROM classes),
    both_ AS (SELECT before, 'gap' AS variant, gap AS after FROM sums UNION ALL SELECT before, 'nogap', nogap FROM sums)""",
    "SELECT variant, before, after, before - after AS lost, printf('%.2f', (before - after) / before * 100) AS lost_percent FROM both_",
)
SQL["site_slice"] = _with(
    GRID + ", " + UNIVERSE,
    """SELECT c.contig || '/' || c.pos AS locus, c."column", CASE WHEN c.gaps > 0 THEN 'gapped' ELSE 'nogaps' END AS part,
         CASE WHEN c.gaps > 0 THEN (SELECT string_agg(CASE WHEN g.base = 'N' THEN 'N' WHEN g.base = '-' THEN '1' ELSE '0' END, '' ORDER BY g.i)
           FROM grid g WHERE g.contig = c.contig AND g.pos = c.pos) END AS recoded
       FROM cols c JOIN universe u ON u.contig = c.contig AND u.pos = c.pos JOIN part p ON p.p_partkey = u.p WHERE p.p_size > 25""",
)
SQL["long_calls"] = _with(GRID, "SELECT taxon, contig, pos, base FROM grid")
SQL["pairwise_identity"] = _with(
    GRID,
    """SELECT a.taxon AS "Sample_A", b.taxon AS "Sample_B", a.taxon || ';' || b.taxon AS "Comparison",
         COUNT(*) FILTER (a.base <> 'N' AND b.base <> 'N') AS "Cocalled_Sites",
         COUNT(*) FILTER (a.base <> 'N' AND a.base = b.base) AS "Identical_Sites",
         COALESCE(COUNT(*) FILTER (a.base <> 'N' AND a.base = b.base) / NULLIF(COUNT(*) FILTER (a.base <> 'N' AND b.base <> 'N'), 0), 0.0) AS "Prop_Identical"
       FROM grid a JOIN grid b ON a.contig = b.contig AND a.pos = b.pos AND a.taxon < b.taxon GROUP BY a.taxon, b.taxon""",
)
SQL["pairwise_gaps"] = _with(
    GRID + """, thin AS (SELECT taxon, contig, pos, CASE WHEN taxon = 't0' AND pos % 2 = 0 OR taxon = 't1' AND pos % 2 = 1 THEN 'N' ELSE base END AS base FROM grid)""",
    """SELECT a.taxon AS "Sample_A", b.taxon AS "Sample_B", a.taxon || ';' || b.taxon AS "Comparison",
         COUNT(*) FILTER (a.base <> 'N' AND b.base <> 'N') AS "Cocalled_Sites",
         COUNT(*) FILTER (a.base <> 'N' AND a.base = b.base) AS "Identical_Sites",
         COALESCE(COUNT(*) FILTER (a.base <> 'N' AND a.base = b.base) / NULLIF(COUNT(*) FILTER (a.base <> 'N' AND b.base <> 'N'), 0), 0.0) AS "Prop_Identical"
       FROM thin a JOIN thin b ON a.contig = b.contig AND a.pos = b.pos AND a.taxon < b.taxon GROUP BY a.taxon, b.taxon""",
)
SQL["sample_classification"] = _with(
    GRID + """, panel AS (SELECT contig, pos, MAX(base) FILTER (i = 0) AS r0, MAX(base) FILTER (i = 1) AS r1, MAX(base) FILTER (i = 2) AS r2
      FROM grid GROUP BY contig, pos),
    hits AS (SELECT g.taxon, g.base = r0 AS h0, g.base = r1 AS h1, g.base = r2 AS h2,
        CAST(g.base = r0 AS INT) + CAST(g.base = r1 AS INT) + CAST(g.base = r2 AS INT) AS k
      FROM grid g JOIN panel p ON p.contig = g.contig AND p.pos = g.pos
      WHERE g.i > 2 AND g.base <> 'N' AND r0 <> 'N' AND r1 <> 'N' AND r2 <> 'N')""",
    """SELECT t.taxon AS "Sample_ID", COUNT(*) FILTER (k = 1 AND h0) AS "Count_t0", COUNT(*) FILTER (k = 1 AND h1) AS "Count_t1",
         COUNT(*) FILTER (k = 1 AND h2) AS "Count_t2", COUNT(*) FILTER (k = 1) AS "Classifier_Sites", COUNT(k) AS "All_Sites",
         COUNT(*) FILTER (k = 0) AS "Count_Singleton", COUNT(*) FILTER (k > 1) AS "Count_Background"
       FROM taxa t LEFT JOIN hits h ON h.taxon = t.taxon WHERE t.i > 2 GROUP BY t.taxon""",
)

# ---- genome projection

MAPS = """maps AS (
  SELECT 'q' || l_orderkey || '_' || l_linenumber AS contig, 'chr' || (l_suppkey % 5) AS chrom,
         CAST(1 + l_orderkey * 10 + l_linenumber * 3 AS BIGINT) AS start,
         CASE WHEN l_partkey % 11 = 0 THEN 4 WHEN l_linestatus = 'O' THEN 0 ELSE 16 END AS direction,
         CAST(l_linenumber AS BIGINT) AS s, CAST(1 + CAST(trunc(l_quantity) AS INT) % 4 AS BIGINT) AS m1,
         CAST(1 + l_linenumber % 3 AS BIGINT) AS d, CAST(l_linenumber AS BIGINT) AS ins, CAST(1 + l_orderkey % 3 AS BIGINT) AS m2
  FROM lineitem)"""
BED = MAPS + """, aligned AS (
  SELECT contig, chrom, direction, m1 + ins + m2 AS len, start + k AS gpos, k AS q FROM (SELECT *, unnest(range(m1)) AS k FROM maps)
  UNION ALL
  SELECT contig, chrom, direction, m1 + ins + m2, start + m1 + d + k, m1 + ins + k FROM (SELECT *, unnest(range(m2)) AS k FROM maps)),
bed AS (
  SELECT chrom, gpos - 1 AS start, gpos AS "end", contig || '/' || CASE WHEN direction = 0 THEN q + 1 ELSE len - q END AS name
  FROM aligned WHERE direction <> 4),
hits AS (SELECT chrom, start, COUNT(*) AS n FROM bed GROUP BY ALL)"""
SQL["mapped_alignments"] = """SELECT l_orderkey, l_linenumber, CAST(l_partkey % 32 AS INT) AS flag FROM lineitem
  WHERE (CAST(l_partkey % 32 AS INT) & 4) = 0"""
SQL["cigar_segments"] = _with(
    MAPS + """, parts AS (SELECT contig, s || 'S' || m1 || 'M' || d || 'D' || ins || 'I' || m2 || 'M' AS cigar,
      [s, m1, d, ins, m2] AS sizes, ['S', 'M', 'D', 'I', 'M'] AS ops FROM maps)""",
    "SELECT contig, cigar, CAST(k AS INT) AS segment, sizes[k + 1] AS size, ops[k + 1] AS op FROM parts CROSS JOIN range(5) r(k)",
)
SQL["query_lengths"] = _with(
    MAPS, "SELECT CAST(direction AS INT) AS direction, COUNT(*) AS n_rows, CAST(SUM(m1 + ins + m2) AS BIGINT) AS total_length FROM maps GROUP BY 1"
)
SQL["genome_projection"] = _with(BED, 'SELECT chrom, start, "end", name FROM bed')
SQL["unique_projection"] = _with(
    BED, 'SELECT b.chrom, b.start, b."end", b.name FROM bed b JOIN hits h ON h.chrom = b.chrom AND h.start = b.start WHERE h.n = 1'
)
SQL["overlap_report"] = _with(
    BED + ", s AS (SELECT CAST(SUM(n) AS BIGINT) AS mapped, COUNT(*) FILTER (n = 1) AS kept FROM hits)",
    """SELECT mapped, mapped - kept AS removed, kept, format('{:,}', mapped) AS mapped_text,
       format('{:,}', mapped - kept) AS removed_text, format('{:,}', kept) AS kept_text FROM s""",
)

# ---- manifests

MANIFEST = """rows_ AS (
  SELECT c_custkey, CASE WHEN c_custkey % 97 <> 5 THEN c_name END AS sample_id,
         CASE WHEN c_nationkey <> 0 THEN c_mktsegment END AS grp,
         CASE WHEN c_nationkey % 7 <> 3 THEN '/reads/' || c_custkey || '_1.fastq.gz' END AS fwd,
         CASE WHEN c_acctbal >= 0 THEN '/reads/' || c_custkey || '_2.fastq.gz' END AS rev FROM customer)"""
SQL["manifest_errors"] = _with(
    MANIFEST,
    """SELECT sample_id, 'sample id is empty' AS problem FROM rows_ WHERE sample_id IS NULL
       UNION ALL SELECT sample_id, 'both reads are empty' FROM rows_ WHERE sample_id IS NOT NULL AND fwd IS NULL AND rev IS NULL
       UNION ALL SELECT sample_id, 'reverse read without forward read' FROM rows_
         WHERE sample_id IS NOT NULL AND fwd IS NULL AND rev IS NOT NULL""",
)
SQL["missing_read_files"] = _with(
    MANIFEST + ", named AS (SELECT c_custkey, sample_id, fwd AS path FROM rows_ UNION ALL SELECT c_custkey, sample_id, rev FROM rows_)",
    """SELECT sample_id, 'read file is missing: ' || path AS problem FROM named n
       WHERE path IS NOT NULL AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = n.c_custkey AND o.o_custkey % 7 <> 0)""",
)
SQL["read_manifest"] = _with(
    MANIFEST,
    """SELECT sample_id, COALESCE(grp, 'Unknown') AS grp, fwd || COALESCE(';' || rev, '') AS reads
       FROM rows_ WHERE sample_id IS NOT NULL AND fwd IS NOT NULL""",
)
FILES = """files AS (
  SELECT DISTINCT o_orderpriority AS grp, o_custkey, o_orderstatus AS st,
         CASE WHEN o_custkey % 50 = 0 THEN 'Undetermined_' ELSE '' END || 'S' || o_custkey AS base,
         '/reads/' || o_orderpriority || '/' || CASE WHEN o_custkey % 50 = 0 THEN 'Undetermined_' ELSE '' END || 'S' || o_custkey AS stem
  FROM orders),
f AS (SELECT * FROM files WHERE st = 'F'), r AS (SELECT * FROM files WHERE st = 'O'),
s AS (SELECT * FROM files WHERE st NOT IN ('F', 'O')),
paired AS (
  SELECT COALESCE(f.grp, r.grp) AS grp, COALESCE(f.base, r.base || '_2') AS sample_id, f.stem IS NOT NULL AND r.stem IS NOT NULL AS two,
         CASE WHEN f.stem IS NULL THEN r.stem || '_2.fastq.gz' WHEN r.stem IS NULL THEN f.stem || '_1.fastq.gz'
              ELSE f.stem || '_1.fastq.gz;' || r.stem || '_2.fastq.gz' END AS reads
  FROM f FULL OUTER JOIN r ON f.stem = r.stem
  UNION ALL SELECT grp, base, FALSE, stem || '.fastq.gz' FROM s)"""
SQL["read_pairing"] = _with(FILES, "SELECT sample_id, grp, reads FROM paired")
SQL["legacy_listing"] = _with(
    FILES, "SELECT sample_id AS base, CASE WHEN two THEN 'Paired' ELSE 'Single' END AS layout, reads AS paths FROM paired WHERE sample_id NOT LIKE 'Undet%'"
)
SQL["duplicate_samples"] = _with(FILES, "SELECT sample_id AS value, COUNT(*) AS n FROM paired GROUP BY 1 HAVING COUNT(*) > 1")
SQL["missing_entries"] = "SELECT 'S' || c_custkey AS name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey % 7 <> 0)"

# ---- budget

STATS = """stats AS (
  SELECT c_custkey AS sample_id, CASE WHEN c_custkey % 20 = 0 THEN 'SMALL' ELSE c_mktsegment END AS grp, COUNT(*) AS read_count,
         CAST(SUM(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS base_count
  FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2),
depths AS (
  SELECT grp, CAST(SUM(base_count) AS BIGINT) AS group_bases, COUNT(*) AS group_samples,
         CAST(floor(200000000000.0::DOUBLE / (SELECT COUNT(DISTINCT grp) FROM stats)) AS BIGINT) AS depth
  FROM stats GROUP BY grp)"""
SQL["read_statistics"] = (
    "SELECT conv_id AS sample_id, COUNT(*) AS read_count, CAST(SUM(length(text)) AS BIGINT) AS base_count FROM conversations GROUP BY 1"
)
SQL["sample_statistics"] = _with(STATS, "SELECT sample_id, grp, read_count, base_count FROM stats")
SQL["group_depths"] = _with(STATS, "SELECT *, group_bases < depth AS takes_all FROM depths")
SQL["budget_allocation"] = _with(
    STATS + """, low AS (
      SELECT s.grp, SUM(s.base_count) FILTER (s.base_count < d.depth / d.group_samples) AS low_bases,
             COUNT(*) FILTER (s.base_count >= d.depth / d.group_samples) AS n_high
      FROM stats s JOIN depths d ON d.grp = s.grp GROUP BY s.grp)""",
    """SELECT s.sample_id, s.grp, s.read_count, s.base_count, CAST(CASE WHEN d.group_bases < d.depth THEN s.base_count
         WHEN s.base_count < d.depth / d.group_samples THEN s.base_count
         ELSE (d.depth - COALESCE(l.low_bases, 0)) // l.n_high END AS BIGINT) AS to_sample
       FROM stats s JOIN depths d ON d.grp = s.grp JOIN low l ON l.grp = s.grp""",
)
SQL["allocation_log"] = _with(
    STATS,
    """SELECT CAST(0 AS INT) AS line_no, 'Genome size estimate: 20000000000 bp' AS line
       UNION ALL SELECT CAST(1 AS INT), 'Desired coverage: 10.0X'
       UNION ALL SELECT CAST(2 AS INT), 'Found ' || COUNT(*) || ' pangenome groups' FROM depths
       UNION ALL SELECT CAST(3 AS INT), 'Requested subset depth: ' || MAX(depth) || ' bp per group' FROM depths
       UNION ALL SELECT CAST(4 AS INT), 'NOTE: ' || grp || ' samples have only ' || group_bases || ' bp. All reads will be used.'
         FROM depths WHERE group_bases < depth""",
)
SQL["read_subsample"] = """WITH reads AS (
  SELECT o_orderpriority AS sample_id, o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS length,
         md5('0:' || o_orderkey) AS h FROM orders),
  ranked AS (SELECT *, SUM(length) OVER (PARTITION BY sample_id ORDER BY h, CAST(o_orderkey AS VARCHAR) ROWS UNBOUNDED PRECEDING) AS upto,
         SUM(length) OVER (PARTITION BY sample_id) // 2 AS target FROM reads)
  SELECT sample_id, o_orderkey, length FROM ranked WHERE upto <= target"""

SQL["paired_subsample"] = """WITH pairs AS (
  SELECT 'S' || (o_custkey % 40) AS sample_id, o_orderkey AS read_no, 20 + o_orderkey % 31 AS one, 10 + o_custkey % 17 AS two FROM orders),
  ranked AS (SELECT *, SUM(one + two) OVER (PARTITION BY sample_id ORDER BY md5('0:' || read_no), CAST(read_no AS VARCHAR) ROWS UNBOUNDED PRECEDING) AS upto,
         2 * SUM(one + two) OVER (PARTITION BY sample_id) // 5 AS target FROM pairs)
  SELECT sample_id, read_no, CAST(e AS INT) AS "end", CAST(CASE WHEN e = 1 THEN one ELSE two END AS INT) AS length
  FROM ranked, (SELECT unnest([1, 2]) AS e) WHERE upto <= target"""

# ---- assemblies

SQL["isolate_ids"] = """SELECT DISTINCT '/asm/' || source || '.' || lang || '_trim.fasta' AS path, source || '.' || lang AS isolate FROM documents"""


def _metrics(contigs: str) -> str:
    return f"""contigs AS ({contigs}),
walk AS (
  SELECT path, length, row_number() OVER w AS i, SUM(length) OVER w AS upto, SUM(length) OVER (PARTITION BY path) AS total
  FROM contigs WINDOW w AS (PARTITION BY path ORDER BY length DESC ROWS UNBOUNDED PRECEDING)),
metrics AS (
  SELECT path, COUNT(*) AS "Contigs", CAST(any_value(total) AS BIGINT) AS "Length",
         CAST(MAX(length) FILTER (upto >= total * 0.5) AS BIGINT) AS "N50", CAST(MAX(length) FILTER (upto >= total * 0.9) AS BIGINT) AS "N90",
         MIN(i) FILTER (upto >= total * 0.5) AS "L50", MIN(i) FILTER (upto >= total * 0.9) AS "L90"
  FROM walk GROUP BY path),
scored AS (
  SELECT *, round_even(COALESCE(("Length" - AVG("Length") OVER ()) / NULLIF(stddev_pop("Length") OVER (), 0), 0), 3) + 0.0 AS "Assembly_Bases_Zscore",
         round_even(COALESCE(("Contigs" - AVG("Contigs") OVER ()) / NULLIF(stddev_pop("Contigs") OVER (), 0), 0), 3) + 0.0 AS "Contig_Count_Zscore",
         round_even(COALESCE(("N50" - AVG("N50") OVER ()) / NULLIF(stddev_pop("N50") OVER (), 0), 0), 3) + 0.0 AS "N50_Zscore"
  FROM metrics)"""


_DOCS = "SELECT '/asm/' || source || '.' || lang || '_trim.fasta' AS path, n_chars AS length FROM documents"
_ISO = "SELECT '/asm/iso' || l_suppkey || '.fasta' AS path, CAST(trunc(l_quantity) AS BIGINT) * 37 + l_linenumber AS length FROM lineitem"
SQL["assembly_metrics"] = _with(_metrics(_DOCS), "SELECT * FROM metrics")
SQL["assembly_zscores"] = _with(_metrics(_DOCS), "SELECT * FROM scored")
INLIERS = _metrics(_ISO) + """, inliers AS (
  SELECT s_suppkey AS id, scored.* FROM scored JOIN supplier ON path = '/asm/iso' || s_suppkey || '.fasta'
  WHERE "N50_Zscore" > -3 AND abs("Assembly_Bases_Zscore") < 3 AND "Contig_Count_Zscore" < 3)"""
SQL["assembly_inliers"] = _with(INLIERS, "SELECT * FROM inliers")

# ---- distances and groups

EDGES = """edges AS (
  SELECT vec_id AS id_a, k AS id_b, round(abs(CAST(embedding[k + 1] AS DOUBLE)) * 1000000) AS dist
  FROM (SELECT vec_id, embedding, unnest(range(least(64, vec_id))) AS k FROM embeddings)),
sym AS (SELECT id_a, id_b, dist FROM edges UNION ALL SELECT id_b, id_a, dist FROM edges)"""
SQL["distance_triangle"] = _with(EDGES, "SELECT id_a, id_b, dist FROM sym")
SQL["triangle_isolates"] = (
    "SELECT vec_id AS id, '/asm/iso' || vec_id || '_trim.fasta' AS path, vec_id AS ord, 'iso' || vec_id AS isolate FROM embeddings"
)
SQL["mean_distances"] = _with(EDGES, 'SELECT id_a AS id, AVG(dist) AS "Mean_Distance" FROM sym GROUP BY id_a')
SQL["group_validation"] = _with(
    EDGES + """, m AS (SELECT AVG(dist) FILTER (a.label = b.label) AS mean_within, AVG(dist) FILTER (a.label <> b.label) AS mean_between
      FROM edges JOIN embeddings a ON a.vec_id = id_a JOIN embeddings b ON b.vec_id = id_b)""",
    "SELECT *, mean_within < mean_between AS valid FROM m",
)
SQL["unknown_assignment"] = _with(
    EDGES + """, near AS (SELECT s.id_a, b.label, s.dist, row_number() OVER (PARTITION BY s.id_a ORDER BY s.dist, s.id_b) AS rk
      FROM sym s JOIN embeddings b ON b.vec_id = s.id_b WHERE s.id_a % 4 = 1 AND s.id_b % 4 <> 1)""",
    """SELECT vec_id AS id, label AS grp FROM embeddings WHERE vec_id % 4 <> 1
       UNION ALL SELECT e.vec_id, CAST(CASE WHEN n.dist < 500 THEN n.label
         ELSE (SELECT MAX(label) + 1 FROM embeddings WHERE vec_id % 4 <> 1) END AS INT)
       FROM embeddings e LEFT JOIN near n ON n.id_a = e.vec_id AND n.rk = 1 WHERE e.vec_id % 4 = 1""",
)
SQL["cluster_shares"] = (
    'SELECT label AS cluster, COUNT(*) AS count, COUNT(*) / SUM(COUNT(*)) OVER () AS "Prop" FROM embeddings GROUP BY label'
)
SQL["identical_rows"] = "SELECT vec_id AS id, MIN(vec_id) OVER (PARTITION BY embedding) AS cluster FROM embeddings"
SQL["silhouettes"] = """WITH v AS (SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
  per AS (SELECT a.id, a.label, b.label AS other, SUM(list_distance(a.e, b.e)) AS total, COUNT(*) AS n FROM v a CROSS JOIN v b GROUP BY ALL),
  ab AS (SELECT id, label, MAX(CASE WHEN other = label AND n > 1 THEN total / (n - 1) END) AS a,
         MIN(CASE WHEN other <> label THEN total / n END) AS b FROM per GROUP BY id, label)
  SELECT id, label AS cluster, round(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END, 6) AS silhouette FROM ab"""
SQL["hierarchical_clusters"] = """
WITH RECURSIVE links AS (
  SELECT vec_id AS a, CAST(k AS BIGINT) AS b FROM (SELECT vec_id, unnest(range(64)) AS k, unnest(embedding) AS x FROM embeddings)
  WHERE k < vec_id AND round(abs(x::DOUBLE) * 1000000) < 400),
ends AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(id, r) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.id, ends.b FROM reach JOIN ends ON ends.a = reach.r)
SELECT id, MIN(r) AS cluster FROM reach GROUP BY id"""
SQL["mixture_of_rows"] = "SELECT vec_id AS id, MIN(vec_id) OVER (PARTITION BY label % 3) AS cluster FROM embeddings"
SQL["kmeans_clusters"] = "SELECT vec_id AS id, MIN(vec_id) OVER (PARTITION BY label % 4) AS cluster FROM embeddings"
SQL["mixture_clusters"] = "SELECT vec_id AS id, MIN(vec_id) OVER (PARTITION BY label % 3) AS cluster FROM embeddings"
SQL["optimal_k"] = """WITH v AS (SELECT vec_id AS id, label % 4 AS g, list_transform(range(4), lambda d: (CASE WHEN label % 4 = d THEN 20.0 ELSE 0.0 END)
      + list_sum(list_transform(range(1, 7), lambda i: abs(CAST(embedding[6 * d + i] AS DOUBLE)) * 10000 % 1)) - 3.0) AS e FROM embeddings),
  per AS (SELECT a.id, a.g, b.g AS other, SUM(list_distance(a.e, b.e)) AS total, COUNT(*) AS n FROM v a CROSS JOIN v b GROUP BY ALL),
  ab AS (SELECT id, MAX(CASE WHEN other = g AND n > 1 THEN total / (n - 1) END) AS a, MIN(CASE WHEN other <> g THEN total / n END) AS b FROM per GROUP BY id),
  cells AS (SELECT g, d, e[d] AS x FROM v, range(1, 5) t(d)),
  cost AS (SELECT SUM(ss) AS cost FROM (SELECT var_pop(x) * COUNT(*) AS ss FROM cells GROUP BY g, d))
  SELECT CAST((SELECT COUNT(DISTINCT g) FROM v) AS INT) AS k, round((SELECT cost FROM cost), 3) AS cost, round(AVG((b - a) / greatest(a, b)), 6) AS score FROM ab"""
BASE = INLIERS + ", " + EDGES + """, near AS (
  SELECT id_a, id_b, dist FROM sym WHERE id_a IN (SELECT id FROM inliers) AND id_b IN (SELECT id FROM inliers)),
means AS (SELECT id_a AS id, AVG(dist) AS md FROM near GROUP BY id_a),
base AS (
  SELECT i.id, i.path, z, "N50_Zscore" - COALESCE(z, 0) AS score FROM (
    SELECT i.*, round_even((md - AVG(md) OVER ()) / NULLIF(stddev_pop(md) OVER (), 0), 3) + 0.0 AS z
    FROM inliers i LEFT JOIN means m ON m.id = i.id) i)"""
SQL["base_scores"] = _with(BASE, 'SELECT id, z AS "Mean_Distance_Zscore", round(score, 6) AS "Base_Score" FROM base')
SQL["top_reference"] = _with(BASE, "SELECT id, path FROM base ORDER BY score DESC, id LIMIT 1")


def _round(n: int) -> str:
    """CTEs of one greedy round; ``chosen{n-1}`` holds the references so far."""
    before = f"chosen{n - 1}"
    return f""", dist{n} AS (SELECT c.id, AVG(e.dist) AS d FROM cand c LEFT JOIN near e ON e.id_a = c.id AND e.id_b IN (SELECT id FROM {before})
      WHERE c.id NOT IN (SELECT id FROM {before}) GROUP BY c.id),
    z{n} AS (SELECT id, round_even((d - AVG(d) OVER ()) / NULLIF(stddev_pop(d) OVER (), 0), 3) AS z FROM dist{n}),
    chosen{n} AS (SELECT id, choice FROM {before} UNION ALL (SELECT c.id, {n} FROM cand c JOIN z{n} z ON z.id = c.id
      ORDER BY c.score + CASE WHEN z.z <= 0 THEN z.z ELSE z.z * c.prop END DESC NULLS LAST, c.id LIMIT 1))"""


SQL["greedy_references"] = _with(
    BASE + """, cand AS (SELECT b.id, b.score, e.label, COUNT(*) OVER (PARTITION BY e.label) / COUNT(*) OVER () AS prop
      FROM base b JOIN embeddings e ON e.vec_id = b.id),
    chosen1 AS (SELECT id, 1 AS choice FROM cand ORDER BY score DESC, id LIMIT 1)""" + _round(2) + _round(3),
    """SELECT c.id, c.label AS cluster, k.id IS NOT NULL AS "Is_Ref", CAST(k.choice AS INT) AS choice
       FROM cand c LEFT JOIN chosen3 k ON k.id = c.id""",
)

TRIANGLE = """edges AS (
  SELECT a.s_suppkey AS id_a, b.s_suppkey AS id_b,
         CASE WHEN a.s_suppkey % 3 = b.s_suppkey % 3 THEN 1000.0 ELSE 100000.0 END + (a.s_suppkey * 7919 + b.s_suppkey * 104729) % 101 AS dist
  FROM supplier a JOIN supplier b ON b.s_suppkey < a.s_suppkey),
sym AS (SELECT id_a, id_b, dist FROM edges UNION ALL SELECT id_b, id_a, dist FROM edges)"""
SQL["reference_selection"] = _with(
    BASE.replace(EDGES, TRIANGLE) + """, cand AS (SELECT *, COUNT(*) OVER (PARTITION BY id % 3) / COUNT(*) OVER () AS prop FROM base),
    chosen1 AS (SELECT id, 1 AS choice FROM cand ORDER BY score DESC, id LIMIT 1)""" + _round(2) + _round(3),
    """SELECT c.id, c.path, round(c.score, 6) AS "Base_Score", k.id IS NOT NULL AS "Is_Ref", CAST(k.choice AS INT) AS choice
       FROM cand c LEFT JOIN chosen3 k ON k.id = c.id""",
)

# ---- run reports

LINES = """lines AS (
  SELECT 'd' || doc_id AS taxon, k AS line_no, parts[k + 1] AS line
  FROM (SELECT doc_id, parts, unnest(range(len(parts))) AS k FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)))"""
SQL["mapping_reports"] = _with(
    LINES + """, near AS (
      SELECT *, MAX(CASE WHEN contains(line, 'qu') THEN line_no END) OVER (PARTITION BY taxon ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS last_hit FROM lines),
    shown AS (SELECT taxon, line_no, line, line_no - lag(line_no) OVER (PARTITION BY taxon ORDER BY line_no) > 1 AS gap
      FROM near WHERE line_no - last_hit <= 4),
    listing AS (SELECT taxon, line_no, 1 AS sub, line FROM shown UNION ALL SELECT taxon, line_no, 0, '--' FROM shown WHERE gap),
    numbered AS (SELECT taxon, line, row_number() OVER (PARTITION BY taxon ORDER BY line_no, sub) AS pos FROM listing)""",
    """SELECT taxon, CASE WHEN pos <= 6 THEN 'composite' ELSE 'specific' END AS section, CAST(pos AS INT) AS at, line
       FROM numbered WHERE pos BETWEEN 2 AND 6 OR pos BETWEEN 9 AND 13""",
)
SQL["site_report_lines"] = _with(LINES, "SELECT taxon, CAST(line_no AS INT) AS line_no, line FROM lines WHERE line LIKE 'Le%'")

# ---- files read in pieces

SQL["fasta_reading"] = """
SELECT 'f' || p_partkey % 5 AS file, 'k' || p_partkey AS contig, CAST(k AS BIGINT) AS "offset", substr(seq, k + 1, 16) AS seq
FROM (SELECT p_partkey, seq, unnest(range(0, len(seq), 16)) AS k
      FROM (SELECT p_partkey, repeat(substr('ACGT', CAST(1 + p_partkey % 4 AS INT), 1), p_size) || repeat(substr('TGNA', CAST(1 + p_size % 4 AS INT), 1), CAST(p_partkey % 37 AS INT)) AS seq FROM part))"""
LETTERS = "string_agg(substr('ACGT-', CAST(1 + (p_partkey * (t + 3) + p_size) % 5 AS INT), 1), '' ORDER BY t)"
SITES_READ = f"""SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS site_ord, 'c' || p_partkey // 50 || '/' || 1 + p_partkey % 50 AS locus, "column"
FROM (SELECT p_partkey, {LETTERS} AS "column" FROM part, range(6) r(t) GROUP BY p_partkey)"""
SQL["phylip_reading"] = f'SELECT site_ord, "column" FROM ({SITES_READ})'
SQL["nexus_reading"] = SITES_READ

SQL["merge_steps"] = f"""
WITH RECURSIVE {TRIANGLE}, d AS (SELECT DISTINCT dist FROM edges),
reach(dist, id, r) AS (
  SELECT d.dist, s_suppkey, s_suppkey FROM d, supplier
  UNION SELECT reach.dist, reach.id, sym.id_b FROM reach JOIN sym ON sym.id_a = reach.r AND sym.dist <= reach.dist),
left_at AS (SELECT dist, COUNT(DISTINCT root) AS n FROM (SELECT dist, id, MIN(r) AS root FROM reach GROUP BY dist, id) GROUP BY dist),
steps AS (SELECT dist, n, lag(n, 1, (SELECT COUNT(*) FROM supplier)) OVER (ORDER BY dist) - n AS merged FROM left_at)
SELECT CAST(dist AS BIGINT) AS dist, merged AS n_merges, n AS n_left FROM steps WHERE merged > 0"""

# ---- reads stacked on their reference

SQL["alignment_pileup"] = """
WITH r AS (
  SELECT lpad(l_orderkey::VARCHAR, 12, '0') || '_' || l_linenumber || '_' || lpad(l_suppkey::VARCHAR, 8, '0') || '_' || lpad(CAST(l_quantity AS INT)::VARCHAR, 3, '0') AS read,
         'c' || l_partkey // 50 AS contig, 1 + l_partkey % 30 AS start, l_orderkey AS o, l_linenumber AS k,
         l_linenumber % 3 AS clip, 4 + l_linenumber % 3 AS first, 1 + l_orderkey % 2 AS more, 1 + l_suppkey % 2 AS less
  FROM lineitem WHERE l_quantity <> 7),
b AS (SELECT *, unnest(range(0, first + 7 + less)) AS x FROM r),
c AS (SELECT read, contig, start, start + x AS pos,
        CASE WHEN x < first THEN substr('ACGT', CAST(1 + (o + (clip + x) * k) % 4 AS INT), 1)
             WHEN x < first + 3 THEN substr('ACGT', CAST(1 + (o + (clip + more + x) * k) % 4 AS INT), 1)
             WHEN x < first + 3 + less THEN '*'
             ELSE substr('ACGT', CAST(1 + (o + (clip + more + x - less) * k) % 4 AS INT), 1) END AS base FROM b),
g AS (SELECT 'c' || p_partkey // 50 AS contig, 1 + p_partkey % 50 AS pos, substr('ACGT', CAST(1 + p_partkey % 4 AS INT), 1) AS ref FROM part)
SELECT contig, pos, COALESCE(ref, 'N') AS ref, CAST(COUNT(*) AS INT) AS depth, string_agg(base, '' ORDER BY start, read) AS decoded
FROM c LEFT JOIN g USING (contig, pos) GROUP BY contig, pos, ref"""

# ---- orders and documents

SQL["run_log_document"] = f"""
WITH log AS (
  SELECT 0 AS part, taxon, section, CAST(m.at AS BIGINT) AS at, line FROM ({SQL["mapping_reports"]}) m
  UNION ALL SELECT 0, taxon, 'taxon sites', CAST(line_no AS BIGINT), line FROM ({SQL["site_report_lines"]})
  UNION ALL SELECT 1, NULL, 'alignment', CAST(n_nationkey AS BIGINT), n_name FROM nation),
heads AS (
  SELECT 0 AS part, taxon, section, CAST(k AS BIGINT) AS at, CASE WHEN k = -2 THEN taxon || ' ' || head ELSE '' END AS line
  FROM (SELECT DISTINCT taxon FROM log WHERE taxon IS NOT NULL),
       (VALUES ('composite', 'Composite Genome Mapping:'), ('specific', 'Specific Genome Mapping:'), ('taxon sites', 'Site Selection:')) h(section, head),
       (VALUES (-3), (-2), (-1)) a(k))
SELECT * FROM log UNION ALL SELECT * FROM heads
UNION ALL SELECT * FROM (VALUES (0, NULL, NULL, -2, ''), (0, NULL, NULL, -1, 'Read Mapping and Site Selection:'), (1, NULL, NULL, -3, ''), (1, NULL, NULL, -2, 'Alignment Filtering:'), (1, NULL, NULL, -1, ''))"""
SQL["reference_order"] = _with(
    BASE + """, r AS (SELECT id, round(score, 6) AS score FROM base), best AS (SELECT id FROM r ORDER BY score DESC, id LIMIT 1)""",
    "SELECT id, row_number() OVER (ORDER BY id NOT IN (SELECT id FROM best), score DESC NULLS LAST, id) AS place FROM r",
)
SQL["slice_order"] = f"""SELECT locus, row_number() OVER (ORDER BY part <> 'nogaps', split_part(locus, '/', 1), CAST(split_part(locus, '/', 2) AS INT)) AS place FROM ({SQL["site_slice"]})"""
SQL["fasta_document"] = """
WITH g AS (SELECT 'c' || p_partkey // 50 AS contig, string_agg(substr('ACGT', CAST(1 + p_partkey % 4 AS INT), 1), '' ORDER BY p_partkey) AS seq FROM part GROUP BY 1),
c AS (SELECT contig, seq, unnest(range(0, len(seq), 16)) AS k FROM g)
SELECT contig, CAST(k AS BIGINT) AS "offset", CAST(CASE WHEN k = 0 THEN 1 ELSE 0 END AS INT) AS part, substr(seq, k + 1, 16) AS line FROM c
UNION ALL SELECT contig, 0, 0, '>' || contig FROM g"""
PILED = "files AS (SELECT 't' || o_custkey AS taxon, COUNT(*) AS n FROM orders WHERE o_orderkey % 5 < 2 GROUP BY 1)"
SQL["taxon_roster"] = _with(PILED, "SELECT COALESCE('t' || c_custkey, taxon) AS taxon, COALESCE(n, 0) AS n FROM customer FULL JOIN files ON taxon = 't' || c_custkey")
SQL["many_pileups"] = _with(PILED, "SELECT taxon, n FROM files WHERE n > 1")
SQL["subset_scheme"] = f"""SELECT sample_id AS "Sample_ID", grp AS "Pangenome_Group", read_count AS "Read_Count", base_count AS "Base_Count", to_sample AS "ToSample" FROM ({SQL["budget_allocation"]})"""

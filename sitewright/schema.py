"""Fixed values and schemas shared by every module."""

from pyspark.sql import types as T

# Alphabets of the data formats.
PILEUP_SYMBOLS = "ACGT*"
CALLED_SYMBOLS = "ACGT-"
ANALYTIC_SYMBOLS = "ACGTacgt-"
MISSING = "N"
UNKNOWN_GROUP = "Unknown"

LOCUS = ["contig", "pos"]

MANIFEST = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("sample_id", "grp", "forward", "reverse")]
)
READ_STATS = T.StructType(
    [
        T.StructField("Sample_ID", T.StringType()),
        T.StructField("Pangenome_Group", T.StringType()),
        T.StructField("Read_Location", T.StringType()),
        T.StructField("Read_Count", T.LongType()),
        T.StructField("Base_Count", T.LongType()),
    ]
)
MAP_DATA = T.StructType(
    [
        T.StructField("contig", T.StringType()),
        T.StructField("chrom", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("direction", T.IntegerType()),
        T.StructField("cigar", T.StringType()),
    ]
)
# Header of the sample sheet a user fills in.
SAMPLE_SHEET_HEADER = ["Sample_ID", "Group", "Forward", "Reverse"]

# Entries a finished pangenome folder must hold.
PANGENOME_FILES = [
    "BBStats",
    "contigs.1.bt2",
    "contigs.2.bt2",
    "contigs.3.bt2",
    "contigs.4.bt2",
    "contigs.fa",
    "contigs.fa.fai",
    "contigs_LocList",
    "contigs.rev.1.bt2",
    "contigs.rev.2.bt2",
    "contigs_SeqLength.tsv",
    "logs",
    "ref",
]

# Alignment format by file extension.
ALIGNMENT_FORMATS = {
    "nex": "nexus",
    "nexus": "nexus",
    "phy": "phylip",
    "phylip": "phylip",
    "phylip-relaxed": "phylip",
    "fa": "fasta",
    "fasta": "fasta",
}


def locus_keys(df) -> list[str]:
    """Locus columns of ``df``, led by the contig order where it has one."""
    return (["contig_ord"] if "contig_ord" in df.columns else []) + LOCUS

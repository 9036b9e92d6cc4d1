"""Column names and explicit schemas of every table in the data model."""

from pyspark.sql import types as T

VARIANT = ["chrom", "pos", "ref", "alt"]
LEAD = ["lead_chrom", "lead_pos", "lead_ref", "lead_alt"]
TAG = ["tag_chrom", "tag_pos", "tag_ref", "tag_alt"]

# One association signal: a dataset plus its lead variant. A null phenotype or
# bio-feature means the dataset has none (a GWAS).
SIGNAL = ["type", "study_id", "phenotype_id", "bio_feature", *LEAD]

# The same signal as the colocalisation tables name it.
COLOC_SIGNAL = ["type", "study", "bio_feature", "phenotype", "chrom", "pos", "ref", "alt"]
SIGNAL_TO_COLOC = {
    "type": "type",
    "study_id": "study",
    "phenotype_id": "phenotype",
    "bio_feature": "bio_feature",
    "lead_chrom": "chrom",
    "lead_pos": "pos",
    "lead_ref": "ref",
    "lead_alt": "alt",
}
NULLABLE_KEYS = ("phenotype", "bio_feature", "phenotype_id")


def sided(side: str, cols) -> list[str]:
    return [f"{side}_{c}" for c in cols]


def both_sides(cols) -> list[str]:
    return sided("left", cols) + sided("right", cols)


COLOC_KEYS = both_sides(COLOC_SIGNAL)
COLOC_STATS = ["coloc_n_vars", "coloc_h0", "coloc_h1", "coloc_h2", "coloc_h3", "coloc_h4"]

# Identity of one colocalisation test when two raw releases are merged.
MERGE_KEYS = COLOC_KEYS

# Identity where the left side is known to be a GWAS and has no phenotype or bio-feature, as in
# processed results. For raw results this is an option: it takes tests for one that differ only
# in the left phenotype or bio-feature.
MERGE_KEYS_GWAS_LEFT = [c for c in COLOC_KEYS if c not in ("left_phenotype", "left_bio_feature")]
MERGE_KEYS_PROCESSED = [*MERGE_KEYS_GWAS_LEFT, "is_flipped", "right_gene_id"]

# One left signal against one right dataset (whatever its lead variant).
DEDUP_KEYS = sided("left", COLOC_SIGNAL) + sided("right", ["type", "study", "bio_feature", "phenotype"])
DEDUP_KEYS_ENRICHED = [c for c in DEDUP_KEYS if c not in ("left_phenotype", "left_bio_feature")]

# Identity of a test across a manifest and an earlier result table.
MANIFEST_KEYS = both_sides(["study_id", "phenotype_id", "bio_feature", *LEAD])

_S, _I, _L, _D, _B = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.DoubleType(),
    T.BooleanType(),
)


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


CREDSET = _struct(
    ("type", _S),
    ("study_id", _S),
    ("phenotype_id", _S),
    ("bio_feature", _S),
    ("lead_chrom", _S),
    ("lead_pos", _I),
    ("lead_ref", _S),
    ("lead_alt", _S),
    ("tag_chrom", _S),
    ("tag_pos", _I),
    ("tag_ref", _S),
    ("tag_alt", _S),
    ("is95_credset", _B),
    ("is99_credset", _B),
    ("multisignal_method", _S),
)

SUMSTATS = _struct(
    ("study_id", _S),
    ("phenotype_id", _S),
    ("bio_feature", _S),
    ("chrom", _S),
    ("pos", _I),
    ("ref", _S),
    ("alt", _S),
    ("beta", _D),
    ("se", _D),
    ("pval", _D),
    ("n_total", _I),
    ("n_cases", _I),
    ("eaf", _D),
    ("is_cc", _B),
)

TOP_LOCI = _struct(
    ("study_id", _S),
    ("phenotype_id", _S),
    ("bio_feature", _S),
    ("chrom", _S),
    ("pos", _I),
    ("ref", _S),
    ("alt", _S),
    ("variant_id", _S),
    ("pval", _D),
)

_SIGNAL_TYPES = {c: (_I if c.endswith("pos") else _S) for c in SIGNAL + COLOC_SIGNAL}

OVERLAP = _struct(
    *[(f"{side}_{c}", _SIGNAL_TYPES[c]) for side in ("left", "right") for c in SIGNAL],
    ("num_overlapping", _L),
    ("left_num_tags", _L),
    ("right_num_tags", _L),
    ("left_overlap_prop", _D),
    ("right_overlap_prop", _D),
)

MANIFEST = _struct(
    *[(f"{side}_{c}", _SIGNAL_TYPES[c]) for side in ("left", "right") for c in SIGNAL],
    ("left_study_class", _S),
    ("right_study_class", _S),
    ("left_has_ld", _B),
    ("right_has_ld", _B),
    ("method", _S),
)

# Result files as the ABF step names them, before renaming.
COLOC_FILE = _struct(
    ("nsnps", _I),
    *[(f"PP.H{h}.abf", _D) for h in range(5)],
    *[(c, _SIGNAL_TYPES[c.split("_", 1)[1]]) for c in COLOC_KEYS],
)

LD_FILE = _struct(
    ("index_variant_id", _S), ("tag_variant_id", _S), ("R_EUR", _D), ("R2_EUR", _D)
)

GENE_LUT = _struct(("phenotype_id", _S), ("gene_id", _S))

def far_schema(schema: T.StructType) -> T.StructType:
    """A schema of the data model with its positions in 64 bits."""
    return T.StructType([T.StructField(f.name, _L if f.name.endswith("pos") else f.dataType, True) for f in schema])


# GRCh38 chromosome lengths in base pairs.
GRCH38_CHROM_LENGTHS = {
    "1": 248956422,
    "2": 242193529,
    "3": 198295559,
    "4": 190214555,
    "5": 181538259,
    "6": 170805979,
    "7": 159345973,
    "8": 145138636,
    "9": 138394717,
    "10": 133797422,
    "11": 135086622,
    "12": 133275309,
    "13": 114364328,
    "14": 107043718,
    "15": 101991189,
    "16": 90338345,
    "17": 83257441,
    "18": 80373285,
    "19": 58617616,
    "20": 64444167,
    "21": 46709983,
    "22": 50818468,
    "X": 156040895,
    "Y": 57227415,
    "MT": 16569,
}

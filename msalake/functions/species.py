"""Species names, species lists, orthology levels and gene-dataset names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .ids import col

# The default species preset, in its published order.
DEFAULT_SPECIES = (
    "homo_sapiens",
    "gorilla_gorilla",
    "macaca_mulatta",
    "monodelphis_domestica",
    "rattus_norvegicus",
    "mus_musculus",
    "bos_taurus",
    "sus_scrofa",
    "ornithorhynchus_anatinus",
    "xenopus_tropicalis",
    "danio_rerio",
    "caenorhabditis_elegans",
)

# Orthology level -> Ensembl relationship types.
ORTHOLOGY_RELATIONSHIPS = {
    "1:1": ("ortholog_one2one",),
    "1:n": ("ortholog_one2one", "ortholog_one2many"),
    "m:n": ("ortholog_one2one", "ortholog_one2many", "ortholog_many2many"),
}

WHITE_SPACE = " \t\n\r\f\v"
GENE_DATASET_SUFFIX = "_gene_ensembl"


def strip(value: Column | str) -> Column:
    """Trim every kind of white space; SQL ``trim`` removes blanks only."""
    return F.btrim(col(value), F.lit(WHITE_SPACE))


def normalize_species(value: Column | str) -> Column:
    return F.lower(F.translate(strip(value), " ", "_"))


def specieslist_preset(value: Column | str) -> Column:
    """struct(specieslist, mode) with mode ``ases``, ``all`` (NULL list) or ``explicit``."""
    text = strip(value)
    return (
        F.when(text == "ases", F.struct(F.lit(",".join(DEFAULT_SPECIES)).alias("specieslist"),
                                        F.lit("ases").alias("mode")))
        .when(text.isin("", "all"), F.struct(F.lit(None).cast("string").alias("specieslist"),
                                             F.lit("all").alias("mode")))
        .when(text.isNotNull(), F.struct(text.alias("specieslist"), F.lit("explicit").alias("mode")))
    )


def unique_nonempty(items: Column) -> Column:
    return F.array_distinct(F.filter(items, lambda s: s.isNotNull() & (s != "")))


def parse_specieslist(value: Column | str) -> Column:
    """Comma list -> normalised distinct names in first-occurrence order; blank -> NULL.

    A list kept in a file is one name per line: read it with ``sources.text.read_lines`` and join the lines
    with commas first.
    """
    text = strip(value)
    names = unique_nonempty(F.transform(F.split(text, ","), normalize_species))
    return F.when(text != "", names)


def orthology_relationships(level: Column | str) -> Column:
    """Relationship types of a level as an array; NULL for an unknown level."""
    wanted = strip(level)
    out = None
    for name, kinds in ORTHOLOGY_RELATIONSHIPS.items():
        kind_array = F.array(*[F.lit(k) for k in kinds])
        out = F.when(wanted == name, kind_array) if out is None else out.when(wanted == name, kind_array)
    return out


def gene_dataset_name(species: Column | str) -> Column:
    """``homo_sapiens`` -> ``hsapiens_gene_ensembl``; NULL unless the name has exactly two parts."""
    parts = F.split(normalize_species(species), "_")
    genus, epithet = parts[0], parts[1]
    two_parts = (F.size(parts) == 2) & (genus != "") & (epithet != "")
    return F.when(two_parts, F.concat(F.substring(genus, 1, 1), epithet, F.lit(GENE_DATASET_SUFFIX)))

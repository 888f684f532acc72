"""Artifact paths relative to a run directory, content hashes and run identities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .ids import col


def normalize_path(path: Column | str) -> Column:
    """Lexically resolve ``.``, ``..`` and doubled slashes of an absolute path."""
    parts = F.aggregate(
        F.split(col(path), "/"),
        F.array().cast("array<string>"),
        lambda done, part: F.when(part.isin("", "."), done)
        .when(part == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .otherwise(F.concat(done, F.array(part))),
    )
    return F.concat(F.lit("/"), F.array_join(parts, "/"))


def relative_path(path: Column | str, root: Column | str) -> Column:
    """An absolute path inside ``root`` becomes relative; every other path stays as it is."""
    path, absolute, base = col(path), normalize_path(path), normalize_path(root)
    inside = F.when(base == "/", absolute.startswith("/")).otherwise(absolute.startswith(F.concat(base, F.lit("/"))))
    skip = F.when(base == "/", 1).otherwise(F.length(base) + 1)
    return (
        F.when(~path.startswith("/"), path)
        .when(absolute == base, ".")
        .when(inside, F.substring(absolute, skip + 1, F.length(absolute)))
        .otherwise(path)
    )


def resolve_path(path: Column | str, root: Column | str) -> Column:
    path, root = col(path), col(root)
    joined = F.concat(F.regexp_replace(root, "/+$", ""), F.lit("/"), path)
    return F.when(path.startswith("/"), path).otherwise(joined)


def relative_paths(struct: Column, root: Column | str, path_fields: tuple[str, ...]) -> Column:
    """Apply :func:`relative_path` to the named fields of a struct."""
    for field in path_fields:
        struct = struct.withField(field, relative_path(struct[field], root))
    return struct


def content_sha256(content: Column | str) -> Column:
    return F.sha2(col(content), 256)


def identity_hash(identity: Column) -> Column:
    """sha256 of the struct as JSON with NULL fields kept, so "absent" is part of the identity."""
    return F.sha2(F.to_json(identity, {"ignoreNullFields": "false"}), 256)


# The fields that make two runs of a stage the same run.
TARGET_IDENTITY = ("input_id", "input_kind", "uniprot_id", "ensembl_gene_id", "transcript_id",
                   "ensembl_protein_id", "species")
SEED_IDENTITY = ("pid", "stockholm_sha256", "fasta_sha256")
EXPANSION_SETTINGS = ("database", "match_mode", "match_ratio", "symfrac", "centroids")
VALIDATION_IDENTITY = TARGET_IDENTITY + ("pid", "stockholm_sha256", "match_stockholm_sha256",
                                         "uniprot_sequence_sha256")
CANDIDATE_IDENTITY = ("gene_id", "transcript_id", "pid_thresholds_key", "pid_sample_count", "pid_sample_fraction",
                      "pid_sample_seed", "sampling_strategy", "effective_specieslist", "orthology",
                      "specieslist_filter", "biomart_datasets_filter", "transcript_query_fingerprint",
                      "selection_mode")
INPUT_IDENTITY = ("gene_id", "transcript_id", "species", "specieslist", "orthology", "source_kind", "source_path",
                  "source_fingerprint")
ALIGNER_IDENTITY = ("aligner", "aligner_args", "input_sha256")


def identity(fields: tuple[str, ...]) -> Column:
    return F.struct(*[F.col(name) for name in fields])


def expansion_identity() -> Column:
    """What makes two expansions one run: the target, the seed's files, and the search settings, each part a struct."""
    return F.struct(identity(TARGET_IDENTITY).alias("target"), identity(SEED_IDENTITY).alias("seed"), identity(EXPANSION_SETTINGS).alias("expansion"))


def differing_fields(left: Column, right: Column, kind: StructType, prefix: str = "") -> Column:
    """Dotted names of the fields in which two structs of one type differ, in field order. NULL equals NULL and nothing else."""
    found = []
    for field in kind.fields:
        a, b, name = left[field.name], right[field.name], prefix + field.name
        if isinstance(field.dataType, StructType):
            found.append(differing_fields(a, b, field.dataType, name + "."))
        else:
            found.append(F.when(a.eqNullSafe(b), F.array().cast("array<string>")).otherwise(F.array(F.lit(name))))
    return F.concat(*found) if found else F.array().cast("array<string>")

"""Process and supplier identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pactum import constants as K
from pactum.functions.text import drop, grab, strip, truthy


def detect_format(pid: Column) -> Column:
    p = strip(pid)
    return (
        F.when(p.rlike(K.ID_FORMAT_B), "B")
        .when(p.rlike(K.ID_FORMAT_C), "C")
        .when(p.rlike(K.ID_FORMAT_A), "A")
        .otherwise("UNKNOWN")
    )


def id_variations(pid: Column) -> Column:
    """Spellings of an identifier, most specific first, without repeats."""
    p = strip(pid)

    def part(pattern: str, group: int) -> Column:
        return F.regexp_extract(p, pattern, group)

    a = r"^(\d+)\.(\d+)/(\d{4})(?:-(\d+))?$"
    joined = F.concat(part(a, 1), part(a, 2))
    one = F.regexp_replace(joined, "^0", "")
    two = F.regexp_replace(one, "^0", "")
    dotted = F.concat(part(a, 1), F.lit("."), part(a, 2))
    short = part(a, 3)
    full = F.when(part(a, 4) != "", F.concat(short, F.lit("-"), part(a, 4))).otherwise(short)
    spell_a = [
        F.concat(stem, F.lit("/"), tail)
        for stem in (dotted, joined, one, two)
        for tail in (full, short)
    ]

    b = r"^([A-Z]+)-([A-Z]+)-(\d{4})/(\d+)$"
    compact = F.concat(part(b, 1), part(b, 2), part(b, 3))
    spell_b = [p, F.concat(compact, F.lit("/"), part(b, 4)), F.concat(compact, part(b, 4))]

    c = r"^(\d+)/(\d+\.\d+)/(\d{4})$"
    spell_c = [p, F.concat(F.lit("0"), p), F.concat(part(c, 1), part(c, 2), part(c, 3))]

    fmt = detect_format(pid)
    return F.array_distinct(
        F.when(fmt == "A", F.array(*spell_a))
        .when(fmt == "B", F.array(*spell_b))
        .when(fmt == "C", F.array(*spell_c))
        .otherwise(F.array(p))
    )


def normalise_pid(pid: Column) -> Column:
    """Cut a trailing ``.- CO 01/2024`` style suffix and loose punctuation."""
    core = F.rtrim(strip(drop(strip(pid), K.PID_SUFFIX, "i")), F.lit(".-"))
    return F.when(truthy(core), core).otherwise(strip(pid))


def pid_slashless(pid: Column) -> Column:
    """The file-safe spelling that only replaces slashes."""
    return F.translate(pid, "/\\", "__")


def pid_wordlike(pid: Column) -> Column:
    """The file-safe spelling that replaces everything but word characters and dashes."""
    return F.regexp_replace(pid, r"(?U)[^\w\-]", "_")


def pid_from_file_name(name: Column) -> Column:
    """Rebuild an identifier from ``<safe pid>_preprocessed.json``."""
    stem = F.replace(F.regexp_replace(name, r"\.json\z", ""), F.lit("_preprocessed"), F.lit(""))
    tail = F.regexp_extract(stem, r"_(\d+)\z", 1)
    head = F.regexp_replace(stem, r"_\d+\z", "")
    dashed = F.translate(head, "_", "-")
    return F.when(tail != "", F.concat(dashed, F.lit("/"), tail)).otherwise(
        F.translate(stem, "_", "-")
    )


def find_cnpj(c: Column) -> Column:
    bare = F.regexp_replace(
        grab(c, K.CNPJ_BARE, 0), r"(\d{2})(\d{3})(\d{3})(\d{4})(\d{2})", "$1.$2.$3/$4-$5"
    )
    return F.coalesce(grab(c, K.CNPJ_FORMATTED, 0), bare)


def company_id(name: Column, cnpj: Column) -> Column:
    slug = F.substring(F.regexp_replace(F.upper(name), "[^a-zA-Z0-9]", ""), 1, K.SLUG_CHARS)
    return F.when(truthy(cnpj), F.regexp_replace(cnpj, r"(?U)\D", "")).otherwise(slug)

"""Content-addressed identifiers as Spark column expressions.

``H(type, body) = sha1(type || ' ' || decimal(len(body)) || 0x00 || body)``
(the git object rule).  Everything stays a JVM expression; ids travel as
40-character lowercase hex strings, raw 20-byte values only inside a body.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that identifiers depend on.
EMPTY_TREE_ID = "4b825dc642cb6eb9a060e54bf8d69288fbee4904"
PERM_FILE = 0o100644
PERM_EXEC = 0o100755
PERM_LINK = 0o120000
PERM_DIR = 0o040000
OFFSET_UTC = "+0000"
REVISION_HEADER_UUID = "svn_repo_uuid"
REVISION_HEADER_REV = "svn_revision"
INF_REV = 9223372036854775807  # open end of a validity interval


def _b(s: str) -> Column:
    return F.lit(s).cast("binary")


def _nul() -> Column:
    return F.unhex(F.lit("00"))


def git_object_id(kind: str, body: Column) -> Column:
    """sha1 of a git object of ``kind`` whose body is the binary ``body``."""
    header = F.concat(_b(kind + " "), F.octet_length(body).cast("string").cast("binary"), _nul())
    return F.sha1(F.concat(header, body))


def blob_id(data: Column) -> Column:
    return git_object_id("blob", data.cast("binary"))


def perms_text(perms: Column) -> Column:
    """Octal permission text as written in a tree entry (``40000`` for dirs)."""
    return F.conv(perms.cast("string"), 10, 8)


def tree_entry_hex(perms: Column, name: Column, target_hex: Column) -> Column:
    """Hex of one tree entry: ``<octal perms> <name>\\0<20 raw bytes>``."""
    return F.concat(
        F.hex(F.concat(perms_text(perms), F.lit(" "), name).cast("binary")),
        F.lit("00"),
        F.lower(target_hex),
    )


def entry_sort_key(name: Column, is_dir: Column) -> Column:
    """Bytes order of entries; a directory sorts as ``name/``."""
    return F.when(is_dir, F.concat(name, F.lit("/"))).otherwise(name).cast("binary")


def tree_id_from_sorted_hex(entries_hex: Column) -> Column:
    """``entries_hex``: array of entry hex strings already in entry order."""
    body = F.unhex(F.array_join(entries_hex, ""))
    return F.coalesce(git_object_id("tree", body), F.lit(EMPTY_TREE_ID))


def sorted_entries_tree_id(entries: Column) -> Column:
    """``entries``: array<struct<sort_key binary, entry_hex string>>, any order."""
    ordered = F.transform(F.array_sort(entries), lambda e: e["entry_hex"])
    return tree_id_from_sorted_hex(ordered)


def git_timestamp(ts: Column) -> Column:
    """``seconds[.micros]`` with trailing zeros of the micros removed."""
    micros = F.unix_micros(ts.cast("timestamp"))
    secs = F.floor(micros / F.lit(1_000_000)).cast("long")
    frac = (micros - secs * F.lit(1_000_000)).cast("long")
    frac_txt = F.regexp_replace(F.lpad(frac.cast("string"), 6, "0"), "0+$", "")
    return F.when(frac == 0, secs.cast("string")).otherwise(
        F.concat(secs.cast("string"), F.lit("."), frac_txt))


def revision_manifest_parts(tree_hex: Column, author: Column, ts: Column, uuid: Column,
                            rev: Column, message: Column) -> tuple[Column, Column]:
    """(prefix, suffix) of a revision body; the parent lines go in between.

    The parent is only known inside the sequential fold, so the JVM builds
    everything else once.
    """
    # a missing date is the epoch
    ts = F.coalesce(ts.cast("timestamp"), F.lit("1970-01-01 00:00:00").cast("timestamp"))
    stamp = F.concat(git_timestamp(ts), F.lit(" " + OFFSET_UTC))
    who = F.coalesce(author, F.lit(""))
    prefix = F.concat(F.lit("tree "), F.lower(tree_hex), F.lit("\n"))
    suffix = F.concat(
        F.lit("author "), who, F.lit(" "), stamp, F.lit("\n"),
        F.lit("committer "), who, F.lit(" "), stamp, F.lit("\n"),
        F.lit(REVISION_HEADER_UUID + " "), uuid, F.lit("\n"),
        F.lit(REVISION_HEADER_REV + " "), rev.cast("string"), F.lit("\n"),
        F.lit("\n"), F.coalesce(message, F.lit("")),
    )
    return prefix, suffix


def snapshot_branch_hex(name: Column, target_type: Column, target_hex: Column) -> Column:
    """Hex of one snapshot branch: ``type name\\0<len>:<target bytes>``.

    ``target_hex`` is a hex id for revision/directory targets; for an alias
    the target is the branch name it points to (pass it already hex-encoded).
    """
    tgt_len = (F.length(target_hex) / 2).cast("int").cast("string")
    return F.concat(
        F.hex(F.concat(target_type, F.lit(" "), name).cast("binary")), F.lit("00"),
        F.hex(F.concat(tgt_len, F.lit(":")).cast("binary")), F.lower(target_hex),
    )


def snapshot_id(branches: Column) -> Column:
    """``branches``: array<struct<name binary, branch_hex string>>."""
    ordered = F.transform(F.array_sort(branches), lambda b: b["branch_hex"])
    return git_object_id("snapshot", F.unhex(F.array_join(ordered, "")))

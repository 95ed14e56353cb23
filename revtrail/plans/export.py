"""Export-time transforms of file data and modes, driven by properties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revtrail.functions.hashing import PERM_DIR, PERM_EXEC, PERM_FILE, PERM_LINK, blob_id
from revtrail.functions.paths import ancestors

# Eol-style property values and the line ending they produce.
EOL_TARGETS = {"native": "\n", "LF": "\n", "CRLF": "\r\n", "CR": "\r"}
SPECIAL_PREFIX = "link "
#: One character for each byte, so data of any encoding comes back as it was.
BYTES = "ISO-8859-1"


def apply_eol(data: Column, style: Column) -> Column:
    """Rewrite every line ending (CRLF, lone CR, lone LF) to the style's
    ending; unknown styles leave the data unchanged."""
    text = F.decode(data, BYTES)
    out = data
    for name, nl in EOL_TARGETS.items():
        out = F.when(style == name, F.encode(F.regexp_replace(text, "\r\n|\r|\n", nl), BYTES)) \
            .otherwise(out)
    return out


def apply_special(data: Column, special: Column) -> tuple[Column, Column]:
    """(data, is_link): with the special property and ``link X`` data the
    node is a symlink whose content is X; otherwise unchanged."""
    text = F.decode(data, BYTES)
    is_link = F.coalesce(special, F.lit(False)) & text.startswith(SPECIAL_PREFIX)
    new = F.when(is_link, F.encode(F.substring(text, len(SPECIAL_PREFIX) + 1, 1 << 30), BYTES)) \
        .otherwise(data)
    return new, is_link


def content_variants(data: Column) -> list[Column]:
    """Ids of the data as exported: as it is, as a link (null if it is none)
    and with each line ending."""
    link, is_link = apply_special(data, F.lit(True))
    ending = lambda style: blob_id(apply_eol(data, F.lit(style)))
    return [blob_id(data).alias("blob_id"), F.when(is_link, blob_id(link)).alias("link_id"), ending("LF").alias("id_lf"),
            ending("CRLF").alias("id_crlf"), ending("CR").alias("id_cr")]


def file_perms(is_link: Column, executable: Column) -> Column:
    """Links win over the executable bit; the bit counts again once the
    node is a regular file."""
    return (F.when(is_link, F.lit(PERM_LINK))
            .when(F.coalesce(executable, F.lit(False)), F.lit(PERM_EXEC))
            .otherwise(F.lit(PERM_FILE)))


def export_tree(files: DataFrame, dirs: DataFrame, at: DataFrame) -> DataFrame:
    """(origin, path, perms, id) of every node at at(origin, at_rev); files as
    exported (with perms), dirs with their tree ids."""
    perms = F.col("perms") if "perms" in files.columns else F.lit(PERM_FILE)
    span = ["from_rev", "to_rev"]
    nodes = files.select("origin", "path", perms.cast("int").alias("perms"), F.col("blob_id").alias("id"), *span).unionByName(
        dirs.where(F.col("path") != "").select("origin", "path", F.lit(PERM_DIR).alias("perms"), F.col("tree_id").alias("id"), *span))
    return nodes.join(at, "origin").where((F.col("from_rev") <= F.col("at_rev")) & (F.col("at_rev") < F.col("to_rev"))) \
        .select("origin", "path", "perms", "id")


def only_subpaths(listing: DataFrame, wanted: DataFrame) -> DataFrame:
    """The nodes of a listing at, below or above the wanted (origin, path)."""
    own = listing.select("origin", "path")
    below = own.select("*", F.explode(ancestors(F.col("path"), include_self=True)).alias("top")) \
        .join(wanted.withColumnRenamed("path", "top"), ["origin", "top"], "left_semi").select("origin", "path")
    above = below.unionByName(wanted.join(own, ["origin", "path"], "left_semi").select("origin", "path")) \
        .select("origin", F.explode(ancestors(F.col("path"), include_self=True)).alias("path"))
    return listing.join(above.distinct(), ["origin", "path"], "left_semi")

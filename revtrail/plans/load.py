"""The load job: change log -> intervals -> trees -> revisions -> snapshots."""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtrail.functions.hashing import snapshot_branch_hex, snapshot_id
from revtrail.operators.chain import revision_chain, with_uuids
from revtrail.operators.copies import as_changes, cleared, copy_rows, expand_copies, expand_once, lineage_of
from revtrail.operators.intervals import Intervals, with_path_parts
from revtrail.operators.ordinals import asof_lookup
from revtrail.operators.props import exported_files, inherited, node_lifetimes, prop_state
from revtrail.operators.trees import TreeVersions, build_trees
from revtrail.session import cut_lineage
from revtrail.sources.adapters import ChangeLog

REV_BUCKET = 4096  # revisions per as-of bucket


def rev_bucket(c):
    return F.floor(c / REV_BUCKET)


class LoadResult:
    """A load whose steps run when they are asked for, and once: who reads the
    intervals alone pays for no trees, and the trees, the tree of each
    revision and the revisions are kept, not worked out by every reader."""

    def __init__(self, log: ChangeLog, intervals: Intervals, lineage: DataFrame, seeds: DataFrame | None = None,
                 prop_events: DataFrame | None = None, variants: DataFrame | None = None, last_rev: int | None = None):
        self.log = log
        self.intervals = intervals  # nodes as in the log
        self.lineage = lineage      # copied nodes: origin, path, rev, src_path, src_rev
        self.variants = variants    # ids of the contents as exported
        self._seeds, self._prop_events = seeds, prop_events
        self._split = last_rev is None or last_rev >= REV_BUCKET

    @cached_property
    def props(self) -> DataFrame | None:
        """Values in force: origin, path, name, value, from_rev, to_rev."""
        if self._prop_events is None:
            return None
        return cut_lineage(prop_state(self._prop_events, node_lifetimes(self.intervals), self.lineage, self._split))

    @cached_property
    def exported(self) -> Intervals:
        """Nodes as exported: properties applied to ids and modes."""
        iv = self.intervals
        if self._prop_events is None:
            return iv
        return Intervals(with_path_parts(cut_lineage(exported_files(iv.files, self.props, self.variants))), iv.dirs)

    @cached_property
    def trees_with_bodies(self) -> TreeVersions:
        """``trees`` with the hashed bytes of each directory."""
        return build_trees(self.exported, self.log.origins, bodies=True)

    @cached_property
    def trees(self) -> TreeVersions:
        if "trees_with_bodies" in self.__dict__:
            made = self.trees_with_bodies
            return TreeVersions(made.dirs.drop("body"), made.root)
        return build_trees(self.exported, self.log.origins)

    @cached_property
    def _commits(self) -> DataFrame:
        """The commits with the tree of each."""
        return cut_lineage(tree_at_revision(self.log.commits, self.trees.root, self.log.commits.columns, self._split))

    @cached_property
    def tree_at_rev(self) -> DataFrame:
        """origin, rev, tree_id"""
        return self._commits.select("origin", "rev", "tree_id")

    @cached_property
    def revisions(self) -> DataFrame:
        """origin, rev, tree_id, revision_id"""
        chain = revision_chain(with_uuids(self._commits, self.log.origins), self._seeds, paired=True)
        return cut_lineage(chain.select("origin", "rev", "tree_id", "revision_id"))

    @cached_property
    def snapshots(self) -> DataFrame:
        """origin, head_rev, tree_id, revision_id, snapshot_id"""
        return head_snapshots(self.revisions)


def tree_at_revision(commits: DataFrame, root: DataFrame, keep: Sequence[str] = ("origin", "rev"), split: bool = True) -> DataFrame:
    """Root tree id in force at every revision (as-of on root versions)."""
    return asof_lookup(commits.select(*keep), root, ["origin"], "rev", "from_rev",
                       ["tree_id"], rev_bucket, split=split)


def head_snapshots(revisions: DataFrame) -> DataFrame:
    """One ``HEAD -> revision`` snapshot per origin, at its last revision."""
    head = revisions.groupBy("origin").agg(
        F.max_by(F.struct("rev", "tree_id", "revision_id"), F.col("rev")).alias("h"))
    branch = F.struct(F.lit("HEAD").cast("binary").alias("name"),
                      snapshot_branch_hex(F.lit("HEAD"), F.lit("revision"),
                                          F.col("h.revision_id")).alias("branch_hex"))
    return head.select("origin", F.col("h.rev").alias("head_rev"),
                       F.col("h.tree_id").alias("tree_id"),
                       F.col("h.revision_id").alias("revision_id"),
                       snapshot_id(F.array(branch)).alias("snapshot_id"))


def load(log: ChangeLog, seeds: DataFrame | None = None, props: DataFrame | None = None,
         variants: DataFrame | None = None, last_rev: int | None = None) -> LoadResult:
    """The full load.  With property events and the variants of the
    contents (see ``props.exported_files``), files are hashed as exported.
    ``last_rev``: no commit, change or property event is later, if known."""
    if last_rev is None:
        last_rev = latest_rev(log, props)
    copied = expand_copies(log.changes, last_rev)
    log = ChangeLog(log.origins, log.commits, copied.changes)
    return LoadResult(log, copied.intervals, copied.lineage, seeds, props, variants, last_rev)


def latest_rev(log: ChangeLog, props: DataFrame | None = None) -> int:
    """The last revision of any commit, change or property event."""
    revs = log.commits.select("rev").unionByName(log.changes.select("rev"))
    if props is not None:
        revs = revs.unionByName(props.select("rev"))
    return revs.agg(F.max("rev")).first()[0] or 0


def visit_snapshots(origins: DataFrame, new: DataFrame, previous: DataFrame) -> DataFrame:
    """(origin, snapshot_id, reused): of each origin the snapshot of its new
    head, else the one of the visit before; neither is an error.  new and
    previous hold origin, snapshot_id."""
    j = origins.join(new.select("origin", F.col("snapshot_id").alias("new_id")), "origin", "left") \
        .join(previous.select("origin", F.col("snapshot_id").alias("old_id")), "origin", "left")
    missing = F.raise_error(F.concat(F.lit("neither a new revision nor a previous snapshot: "), "origin")).cast("string")
    return j.select("origin", F.coalesce("new_id", "old_id", missing).alias("snapshot_id"), F.col("new_id").isNull().alias("reused"))


def new_by_revision(res: LoadResult, max_size: int) -> DataFrame:
    """(origin, rev, contents, skipped, directories): distinct objects that an
    origin holds for the first time at each revision that brings any."""
    kind = F.when(F.col("length") > max_size, "skipped").otherwise("contents")
    files = res.intervals.files.select("origin", F.col("blob_id").alias("id"), kind.alias("kind"), F.col("from_rev").alias("rev"))
    dirs = res.trees.dirs.where(F.col("to_rev") > 1).select(
        "origin", F.col("tree_id").alias("id"), F.lit("directories").alias("kind"), F.greatest("from_rev", F.lit(1)).alias("rev"))
    first = files.unionByName(dirs).groupBy("origin", "kind", "id").agg(F.min("rev").alias("rev"))
    count = lambda k: F.count_if(F.col("kind") == k).alias(k)
    return first.groupBy("origin", "rev").agg(count("contents"), count("skipped"), count("directories"))


def in_force(intervals: DataFrame, at_rev: DataFrame) -> DataFrame:
    """The rows of intervals that hold at each origin's ``at_rev``."""
    return intervals.join(at_rev, "origin").where((F.col("from_rev") <= F.col("at_rev")) & (F.col("at_rev") < F.col("to_rev")))


def archived_props(state: DataFrame, at_rev: DataFrame) -> DataFrame:
    """The property values in force at ``at_rev`` as events of that
    revision, from which a later batch goes on."""
    return in_force(state, at_rev).select("origin", F.col("at_rev").alias("rev"), "path", "name", "value")


def archived_state(res: LoadResult, at_rev: DataFrame) -> DataFrame:
    """The tree in force at each origin's ``at_rev`` (origin, at_rev) as put
    rows at that revision: the persisted open intervals a later batch
    resumes from, so nothing is replayed from revision 1."""
    from revtrail.sources.adapters import SEQ_PUT
    iv = res.intervals
    files = (in_force(iv.files, at_rev)
             .select("origin", F.col("at_rev").alias("rev"), "path", F.lit("file").alias("kind"),
                     "blob_id", "length"))
    dirs = (in_force(iv.dirs, at_rev)
            .select("origin", F.col("at_rev").alias("rev"), "path", F.lit("dir").alias("kind"),
                    F.lit(None).cast("string").alias("blob_id"), F.lit(None).cast("long").alias("length")))
    return files.unionByName(dirs).select(
        "origin", "rev", F.lit(SEQ_PUT).alias("seq"), "path", "kind", F.lit("put").alias("action"),
        F.lit(None).cast("string").alias("copyfrom_path"), F.lit(-1).cast("long").alias("copyfrom_rev"),
        "blob_id", "length")


def load_incremental(log: ChangeLog, previous: LoadResult, last_rev: DataFrame, props: DataFrame | None = None,
                     variants: DataFrame | None = None, latest: int | None = None) -> LoadResult:
    """Load only the revisions after each origin's ``last_rev`` (origin,
    at_rev), starting from the archived tree and property values and chained
    onto the archived revision id.  ``variants`` holds those of the archived
    contents in force, too.  ``latest``: no commit, change or property event
    is later, if known."""
    after = lambda df: df.join(last_rev, "origin").where(F.col("rev") > F.col("at_rev")).drop("at_rev")
    new_changes, new_commits = after(log.changes), after(log.commits)
    # a copy from an archived revision reads the archived intervals, closed ones too
    copies = copy_rows(new_changes).join(last_rev, "origin").withColumn("archived", F.col("src_rev") <= F.col("at_rev")).drop("at_rev")
    old = cut_lineage(copies.where("archived").drop("archived"))
    of_old = old.select("origin", "rev", F.col("dst").alias("path"))
    rest = new_changes.where(F.col("copyfrom_rev") == -1).unionByName(
        new_changes.where(F.col("copyfrom_rev") != -1).join(of_old, ["origin", "rev", "path"], "left_anti"))
    expanded = expand_once(old, previous.intervals)
    if props is not None:
        expanded = cut_lineage(expanded)
    new_changes = rest.unionByName(cleared(old)).unionByName(as_changes(expanded))
    state = archived_state(previous, last_rev)
    inc_log = ChangeLog(log.origins, new_commits, state.unionByName(new_changes))
    if props is not None:
        # values that hold, those a copy takes from the archive, and the new events, which count over them
        new = after(props)
        taken = inherited(lineage_of(expanded, old, rest), previous.props) \
            .select("origin", "rev", "path", "name", "value").join(new, ["origin", "rev", "path", "name"], "left_anti")
        props = cut_lineage(archived_props(previous.props, last_rev).unionByName(taken).unionByName(new))
    seeds = (previous.revisions.join(last_rev, "origin").where(F.col("rev") == F.col("at_rev"))
             .select("origin", F.col("revision_id").alias("seed_parent")))
    return load(inc_log, seeds=seeds, props=props, variants=variants, last_rev=latest)

"""Inventories and how they compare: targets, manifests, coverage, placement, integrity, what changed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statloom.functions import identity as I
from statloom.functions.text import is_plain_chapter


def section_targets(sections: DataFrame) -> DataFrame:
    """(key, number, title, href) of the code's own sections; where an old and a live one share a key, the live one."""
    own = sections.where("docType = 'hrs'").select(I.citation_key(F.col("sectionNumber")).alias("key"), F.col("sectionNumber").alias("number"), "title", I.href("section", F.col("sectionNumber")).alias("href"))
    best = own.groupBy("key").agg(F.min_by(F.struct("number", "title", "href"), F.struct(F.col("number").endswith("[OLD]"), "number", "title")).alias("t"))
    return best.select("key", "t.*")


def chapter_targets(manifest_chapters: DataFrame, records: DataFrame | None = None) -> DataFrame:
    """(key, number, title, href) of chapters, from the manifest, so that chapters without sections are there; a record's title comes first."""
    c = manifest_chapters.select(F.col("chapter").alias("key"), "title")
    if records is not None:
        c = c.join(records.select(F.col("chapter").alias("__c"), F.col("title").alias("__t")), F.col("key") == F.col("__c"), "left").select("key", F.coalesce("__t", "title").alias("title"))
    return c.select("key", F.col("key").alias("number"), "title", I.href("chapter", F.col("key")).alias("href"))


def flatten_manifest(manifest: DataFrame) -> DataFrame:
    """One row per file of a nested manifest (volumes of chapters of files)."""
    v = manifest.select(F.explode("volumes").alias("v")).select("v.number", "v.dirName", F.explode("v.chapters").alias("c"))
    f = v.select(F.col("number").alias("volume"), F.col("c.number").alias("chapter"), F.col("c.title").alias("title"), F.explode("c.files").alias("f"))
    return f.select("volume", "chapter", "title", F.col("f.filename").alias("filename"), F.col("f.url").alias("url"), F.col("f.isIndex").alias("is_index"))


def manifest_totals(manifest: DataFrame) -> DataFrame:
    """Number of volumes, chapters and files."""
    count = F.aggregate("volumes", F.lit(0).cast("long"), lambda s, v: s + F.aggregate(v["chapters"], F.lit(0).cast("long"), lambda t, c: t + F.size(c["files"])))
    chapters = F.aggregate("volumes", F.lit(0).cast("long"), lambda s, v: s + F.size(v["chapters"]))
    return manifest.select(F.size("volumes").cast("long").alias("volumes"), chapters.alias("chapters"), count.alias("files"))


def nest_manifest(files: DataFrame) -> DataFrame:
    """One row with the nested manifest of (volume, chapter, title, filename, url, is_index) rows; names in order. A sink's form."""
    f = F.struct("filename", "url", F.col("is_index").alias("isIndex"))
    c = files.groupBy("volume", "chapter", "title").agg(F.sort_array(F.collect_list(f)).alias("files"))
    v = c.groupBy("volume").agg(F.sort_array(F.collect_list(F.struct(F.col("chapter").alias("number"), "title", "files"))).alias("chapters"))
    v = v.select(F.col("volume").alias("number"), F.concat(F.lit("Vol"), F.lpad(F.col("volume").cast("string"), 2, "0")).alias("dirName"), "chapters")
    return v.agg(F.sort_array(F.collect_list(F.struct("number", "dirName", "chapters"))).alias("volumes"))


def pending(jobs: DataFrame, done: DataFrame, key: str = "url", limit: int | None = None) -> DataFrame:
    """Jobs that no run has completed yet; failed ones are tried again. A limit takes the first in key order."""
    left = jobs.join(done.where("error is null").select(key).distinct() if "error" in done.columns else done.select(key).distinct(), key, "left_anti")
    return left if limit is None else left.orderBy(key).limit(limit)


def coverage(listed: DataFrame, corpus: DataFrame, keys: Sequence[str] = ("chapter", "number")) -> DataFrame:
    """(keys, state): matched, absent (listed only) or unlisted (in the corpus only)."""
    a, b = listed.select(*keys).distinct().withColumn("__a", F.lit(True)), corpus.select(*keys).distinct().withColumn("__b", F.lit(True))
    state = F.when(F.col("__a") & F.col("__b"), "matched").when(F.col("__a"), "absent").otherwise("unlisted")
    return a.join(b, list(keys), "full").select(*keys, state.alias("state"))


def coverage_summary(compared: DataFrame, corpus: DataFrame, keys: Sequence[str] = ("chapter", "number"), repealed: str = "isRepealed") -> DataFrame:
    """Listed, matched, absent, unlisted (repealed and live) and the matched share in per cent, in one row."""
    r = corpus.groupBy(*keys).agg(F.bool_or(repealed).alias("__r"))
    n = lambda c: F.count_if(c)
    s = F.col("state")
    c = compared.join(r, list(keys), "left").agg(
        n(s != "unlisted").alias("listed"), n(s == "matched").alias("matched"), n(s == "absent").alias("absent"), n(s == "unlisted").alias("unlisted"),
        n((s == "unlisted") & F.coalesce("__r", F.lit(False))).alias("unlisted_repealed"), n((s == "unlisted") & ~F.coalesce("__r", F.lit(False))).alias("unlisted_live"),
    )
    return c.withColumn("matched_pct", F.coalesce(F.round(100 * F.col("matched") / F.nullif(F.col("listed"), F.lit(0)), 2), F.lit(0.0)))


def gaps(compared: DataFrame, k: int | None = 15) -> DataFrame:
    """What is absent or unlisted in natural order, the first k of each unless None."""
    w = Window.partitionBy("state").orderBy(I.natural_key(F.col("number")), "number")
    g = compared.where("state <> 'matched'").withColumn("nth", F.row_number().over(w))
    return g if k is None else g.where(F.col("nth") <= k)


def duplicates(rows: DataFrame, key: str, by: str) -> DataFrame:
    """Keys that several ``by`` claim: (key, n, first, last)."""
    return rows.groupBy(key).agg(F.count_distinct(by).alias("n"), F.min(by).alias("first"), F.max(by).alias("last")).where("n > 1")


def slug_collisions(sections: DataFrame, number: str = "sectionNumber") -> DataFrame:
    """Slugs that several numbers would have."""
    return duplicates(sections.select(F.col(number), I.slug(F.col(number)).alias("slug")), "slug", number)


def check_slugs(sections: DataFrame, number: str = "sectionNumber") -> DataFrame:
    bad = slug_collisions(sections, number).limit(1).collect()
    if bad:
        raise ValueError(f"slug {bad[0].slug} of {bad[0]['first']} and {bad[0]['last']}")
    return sections


def pick_record(rows: DataFrame, group: str, title: str, name: str) -> DataFrame:
    """One row of each group: the first by name with a title, else the first; whatever order the rows come in."""
    w = Window.partitionBy(group).orderBy(F.coalesce(F.col(title), F.lit("")) == "", name)
    return rows.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def place_unlisted(chapters: DataFrame, listing: DataFrame) -> DataFrame:
    """(chapter, title, group_pos): where chapters that no table lists belong.

    The last title whose first chapter isn't after it, then that title's last group in the same way, else its first. chapters before any title have
    no place. listing: (title, title_pos, group_pos, chapter_pos, chapter). An as-of join: placed by one sort over both sides' keys.
    """
    key = lambda c: I.natural_key(F.col(c), 6)
    firsts = listing.groupBy("title", "title_pos").agg(F.min_by("chapter", F.struct("group_pos", "chapter_pos")).alias("first")).select("title", "title_pos", key("first").alias("k"))
    groups = listing.groupBy("title", "group_pos").agg(F.min_by("chapter", "chapter_pos").alias("first")).select("title", "group_pos", key("first").alias("k"))
    new = chapters.where(is_plain_chapter(F.col("chapter"))).join(listing.select("chapter"), "chapter", "left_anti").select("chapter", key("chapter").alias("k"))
    none = F.lit(None)
    # running maximum of the title's place, not of its key: later titles win
    mixed = firsts.select("k", F.lit(0).alias("side"), F.struct("title_pos", "title").alias("t"), none.cast("string").alias("chapter")).unionByName(new.select("k", F.lit(1).alias("side"), none.cast("struct<title_pos:int,title:string>").alias("t") if dict(firsts.dtypes)["title_pos"] == "int" else none.cast("struct<title_pos:bigint,title:string>").alias("t"), "chapter"))
    w = Window.partitionBy(F.lit(0)).orderBy("k", "side").rowsBetween(Window.unboundedPreceding, 0)  # one row per chapter of the code
    in_title = mixed.withColumn("t", F.max("t").over(w)).where("side = 1 and t is not null").select("chapter", "k", "t.title")
    at = in_title.join(groups.select("title", "group_pos", F.col("k").alias("g")), "title").groupBy("chapter", "title").agg(F.coalesce(F.max(F.when(F.col("g") <= F.col("k"), F.col("group_pos"))), F.min("group_pos")).alias("group_pos"))
    return at


def outside_hierarchy(chapters: DataFrame, listing: DataFrame) -> DataFrame:
    """Chapters that are neither listed nor plainly numbered: the other documents."""
    return chapters.where(~is_plain_chapter(F.col("chapter"))).join(listing.select("chapter").distinct(), "chapter", "left_anti")


def missing_required(required: DataFrame, present: DataFrame, key: str = "path") -> DataFrame:
    return required.select(key).join(present.select(key), key, "left_anti")


def missing_parents(rows: DataFrame, parents: DataFrame, key: str, parent_key: str) -> DataFrame:
    """Rows whose foreign key names no parent; a null key names none and is no error."""
    return rows.where(F.col(key).isNotNull()).join(parents.select(F.col(parent_key).alias("__p")), F.col(key) == F.col("__p"), "left_anti")


def changed_rows(new: DataFrame, old: DataFrame, key: str | Sequence[str], digest: Column) -> DataFrame:
    """(key, state): unchanged, changed or created against the stored version; a sink writes only the latter two."""
    keys = [key] if isinstance(key, str) else [*key]
    n, o = new.select(*keys, digest.alias("__new")), old.select(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)), digest.alias("__old"))
    same = reduce(lambda a, b: a & b, (F.col(k) == F.col(f"__k{i}") for i, k in enumerate(keys)))
    state = F.when(F.col("__k0").isNull(), "created").when(F.col("__new").eqNullSafe(F.col("__old")), "unchanged").otherwise("changed")
    return n.join(o, same, "left").select(*keys, state.alias("state"))


def upsert(stored: DataFrame, new: DataFrame, key: str, keep_if_empty: Sequence[str] = ()) -> DataFrame:
    """The stored rows with the new ones merged in: new values win, but an empty one of ``keep_if_empty`` leaves what was."""
    n = new.select(*(F.col(c).alias(f"__{c}") for c in stored.columns), F.lit(True).alias("__there"))
    cols = []
    for c in stored.columns:
        fresh = F.nullif(F.col(f"__{c}"), F.lit("")) if c in keep_if_empty else F.col(f"__{c}")
        value = F.coalesce(fresh, F.col(c)) if c == key or c in keep_if_empty else F.when(F.col("__there"), fresh).otherwise(F.col(c))
        cols.append(value.alias(c))
    return stored.join(n, F.col(key) == F.col(f"__{key}"), "full").select(*cols)


def discover(listings: DataFrame, root: str) -> DataFrame:
    """(volume, chapter, filename, url, is_index) of all files three levels below ``root``.

    listings: (base, html), one row per directory page. Directories of volumes are told by a number in their name. A directory without a page gives nothing.
    """
    from statloom.operators.pages import directory_entries

    e = directory_entries(listings, "base")
    dirs = e.where("is_dir").select("base", "name", "url")
    volumes = dirs.where((F.col("base") == root) & F.col("name").rlike("[0-9]")).select(F.regexp_extract("name", "([0-9]+)", 1).cast("int").alias("volume"), F.col("url").alias("v"))
    chapters = dirs.join(volumes, F.col("base") == F.col("v")).select("volume", I.chapter_of_directory(F.col("name")).alias("chapter"), F.col("url").alias("c"))
    files = e.where("not is_dir").select("base", F.col("name").alias("filename"), "url")
    return files.join(chapters, F.col("base") == F.col("c")).select("volume", "chapter", "filename", "url", I.is_index_file(F.col("filename")).alias("is_index"))

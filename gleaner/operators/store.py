"""The note store as a table: lookups, merges, slug collisions, size limits, upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.tags import (
    confidence, has_tag, max_profile_score, merge_relevance_union, merge_tags, no_tags,
)
from gleaner.functions.text import collision_detail, slug_suffix_title, slugify, squatter_reason
from gleaner.functions.urls import arxiv_id_from_url, with_normalised_url
from gleaner.session import checkpoint_dir
from gleaner.vocabulary import TAGS, TagVocabulary


def one_note_per(notes: DataFrame, key: str, columns: list[str], id_column: str = "note_id") -> DataFrame:
    """One row per key, the lowest id: what a lookup may join to without multiplying rows."""
    return (
        notes.where(F.coalesce(F.col(key), F.lit("")) != "")
        .groupBy(key)
        .agg(F.min_by(F.struct(id_column, *[c for c in columns if c != id_column]), id_column).alias("_row"))
        .select(key, "_row.*")
    )


def cache_lookup(incoming: DataFrame, notes: DataFrame, query: str | None = None) -> DataFrame:
    """Add `cache_hit` and `note_id` by normalised url; without a url (or query, where given) there is no hit."""
    known = one_note_per(with_normalised_url(notes.select("note_id", "source_url"), "source_url", "_url"), "_url", ["note_id"])
    asked = F.coalesce(F.col("source_url"), F.lit("")) != ""
    if query is not None:
        asked = asked & (F.coalesce(F.col(query), F.lit("")) != "")
    keyed = with_normalised_url(incoming, "source_url", "_url").withColumn("_url", F.when(asked, F.col("_url")))
    return keyed.join(known, "_url", "left").withColumn("cache_hit", F.col("note_id").isNotNull()).drop("_url")


def skip_cache_hits(incoming: DataFrame, notes: DataFrame) -> DataFrame:
    """Backfill form: rows whose url is not in the store."""
    keyed = with_normalised_url(incoming, "source_url", "_url")
    known = with_normalised_url(notes.select("source_url"), "source_url", "_url").select("_url")
    return keyed.join(known, "_url", "left_anti").drop("_url")


def flag_archive_terminal(candidates: DataFrame, notes: DataFrame, vocab: TagVocabulary = TAGS) -> DataFrame:
    """Mark candidates whose note gave up on its archive: they skip the download and count as missing."""
    given_up = (
        notes.where(has_tag(F.col("tags"), vocab.archive_terminal))
        .select(F.explode("tags").alias("t"), "tags")
        .where(F.col("t").startswith("arxiv-id:"))
        .select(F.substr("t", F.lit(10)).alias("item_id"), F.explode("tags").alias("p"))
        .where(F.col("p").startswith("profile:"))
        .select("item_id", F.substr("p", F.lit(9)).alias("profile"))
        .distinct()
        .withColumn("_hit", F.lit(True))
    )
    flag = F.coalesce(F.col("_hit"), F.lit(False))
    return (
        candidates.join(given_up, ["profile", "item_id"], "left")
        .withColumn("archive_terminal", flag).withColumn("archive_missing", flag).drop("_hit")
    )


def apply_rejection_guard(tags: Column, vocab: TagVocabulary = TAGS) -> Column:
    """Profile tags without the rejected profiles, order kept."""
    return F.filter(
        tags,
        lambda t: ~(t.startswith("profile:") & F.array_contains(
            tags, F.concat(F.lit(vocab.rejected_prefix), F.substr(t, F.lit(9))))),
    )


def combine_incoming(incoming: DataFrame, key: str = "source_url") -> DataFrame:
    """One row per note key from the rows several profiles bring for it, as if written one at a time in id order.

    The title is the first row's, since later writes update the note and leave its title alone; of each profile the
    last row's score and reason count, and the content is that of the last row.  Rows are first reduced to one per
    (key, profile), so the lists collected per key are no longer than the number of configured profiles.
    """
    entry = F.struct("profile", F.col("score").cast("int").alias("score"), "reason")
    others = [c for c in incoming.columns if c not in (key, "profile", "score", "reason", "tags", "title")]
    order = F.struct("item_id", "profile")
    per_profile = (
        incoming.withColumn("_e", entry).withColumn("_order", order)
        .groupBy(key, "profile")
        .agg(F.max_by(F.struct(*others, "tags", "_e"), "_order").alias("_last"), F.max("_order").alias("_newest"),
             F.min_by(F.struct("title", "item_id"), "_order").alias("_first"), F.min("_order").alias("_oldest"))
    )
    kept = [c for c in others if c != "item_id"]
    return (
        per_profile.groupBy(key)
        .agg(
            F.min_by("_first", "_oldest").alias("_first"), F.max_by("_last", "_newest").alias("_last"),
            F.sort_array(F.collect_list(F.struct(
                "profile", F.col("_last.tags").alias("tags"), F.col("_last._e").alias("e")))).alias("_all"),
        )
        .select(
            key, "_first.item_id", "_first.title", *[F.col(f"_last.{c}").alias(c) for c in kept],
            F.array_distinct(F.flatten(F.transform("_all", lambda r: r["tags"]))).alias("tags"),
            F.transform("_all", lambda r: r["e"]).alias("relevance"),
        )
    )


def merge_notes(existing: DataFrame, incoming: DataFrame, key: str = "source_url",
                vocab: TagVocabulary = TAGS) -> DataFrame:
    """Full outer merge: tags by the tag rule, relevance united, user notes always the existing ones.

    Both sides have one row per key and the columns key, title, tags, relevance, confidence, user_notes, version.
    Content columns that both have are taken from the incoming row where there is one.
    """
    merged = (key, "title", "tags", "relevance", "confidence", "user_notes", "version")
    content = [c for c in existing.columns if c in incoming.columns and c not in merged]
    old, new = existing.alias("o"), incoming.alias("n")
    o, n = (lambda c: F.col(f"o.{c}")), (lambda c: F.col(f"n.{c}"))
    tags = F.when(n(key).isNull(), o("tags")).when(o(key).isNull(), n("tags")).otherwise(
        merge_tags(o("tags"), n("tags"), vocab))
    guard = F.concat(F.coalesce(o("tags"), no_tags()), F.coalesce(n("tags"), no_tags()))
    relevance = F.when(n(key).isNull(), o("relevance")).otherwise(
        merge_relevance_union(o("relevance"), n("relevance"), guard, vocab))
    status = F.when(n(key).isNull(), "unchanged").when(o(key).isNull(), "created").otherwise("updated")
    return old.join(new, o(key) == n(key), "full_outer").select(
        F.coalesce(o(key), n(key)).alias(key),
        F.coalesce(n("title"), o("title")).alias("title"),
        tags.alias("tags"),
        relevance.alias("relevance"),
        F.when(n(key).isNull(), o("confidence")).otherwise(
            confidence(F.coalesce(o("confidence"), F.lit(0.0)), max_profile_score(relevance))).alias("confidence"),
        F.coalesce(o("user_notes"), n("user_notes")).alias("user_notes"),
        (F.coalesce(o("version"), F.lit(0)) + F.when(n(key).isNull(), 0).otherwise(1)).cast("bigint").alias("version"),
        status.alias("status"),
        *[F.when(n(key).isNull(), o(c)).otherwise(n(c)).alias(c) for c in content],
    )


def collision_kind(incoming_url: Column, tags: Column, holder_url: Column, body: Column) -> Column:
    """duplicate, reclaimable or distinct: what the note holding a slug is to the incoming one."""
    arxiv = arxiv_id_from_url(incoming_url)
    same_paper = arxiv.isNotNull() & has_tag(tags, F.concat(F.lit("arxiv-id:"), arxiv))
    url = F.coalesce(holder_url, F.lit(""))
    empty = (F.coalesce(F.size(tags), F.lit(0)) <= 0) & (url == "") & (F.trim(F.coalesce(body, F.lit(""))) == "")
    return (
        F.when(F.coalesce(same_paper, F.lit(False)) | ((url != "") & (url == incoming_url)), "duplicate")
        .when(empty, "reclaimable").otherwise("distinct")
    )


def _holders(existing: DataFrame) -> DataFrame:
    return one_note_per(existing, "slug", ["note_id", "tags", "source_url", "body"]).select(
        "slug", F.col("note_id").alias("holder_id"), F.col("tags").alias("holder_tags"),
        F.col("source_url").alias("holder_url"), F.col("body").alias("holder_body"),
    )


def classify_collision(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """Incoming rows whose slug is taken, with `kind` and `reason`."""
    found = incoming.join(_holders(existing), "slug")
    kind = collision_kind(F.col("source_url"), F.col("holder_tags"), F.col("holder_url"), F.col("holder_body"))
    arxiv = arxiv_id_from_url(F.col("source_url"))
    tagged = F.when(has_tag(F.col("holder_tags"), F.concat(F.lit("arxiv-id:"), arxiv)), arxiv)
    return found.withColumn("kind", kind).withColumn(
        "reason",
        squatter_reason(F.col("kind"), tagged, F.col("holder_url"), F.size("holder_tags"),
                        F.length(F.coalesce("holder_body", F.lit("")))),
    )


def _claim(rows: DataFrame, existing: DataFrame, id_column: str) -> DataFrame:
    """One writing round: who holds each row's slug (a stored note, or the first row of the batch), and the outcome."""
    stored = rows.join(_holders(existing), "slug", "left").withColumn(
        "kind",
        F.when(F.col("holder_id").isNotNull(), collision_kind(
            F.col("source_url"), F.col("holder_tags"), F.col("holder_url"), F.col("holder_body"))),
    )
    free = F.col("kind").isNull() | (F.col("kind") == "reclaimable")
    # the first row asking for a free slug gets it; later rows meet that row
    me = F.struct(F.col(id_column).alias("id"), F.col("source_url").alias("url"))
    firsts = stored.where(free).groupBy("slug").agg(F.min(me).alias("_first"))
    joined = stored.join(firsts, "slug", "left")
    is_first = free & (F.col("_first.id") == F.col(id_column))
    later = free & ~is_first
    arxiv = arxiv_id_from_url(F.col("source_url"))
    same = (F.col("_first.url") == F.col("source_url")) | F.coalesce(
        arxiv == arxiv_id_from_url(F.col("_first.url")), F.lit(False))
    return joined.select(
        *rows.columns,
        F.when(is_first, "created")
        .when(later & same, "duplicate").when(later, "collision")
        .when(F.col("kind") == "duplicate", "duplicate").otherwise("collision").alias("outcome"),
        F.when(is_first & (F.col("kind") == "reclaimable"), F.col("holder_id")).alias("reclaimed_id"),
        F.when(later, F.col("_first.id").cast("string")).when(~is_first, F.col("holder_id").cast("string"))
        .alias("blocked_by"),
    )


def resolve_collisions(incoming: DataFrame, existing: DataFrame, id_column: str = "item_id") -> DataFrame:
    """Write status of every incoming row: (id, source_url, title, slug, status, reclaimed_id, detail).

    Round one tries the plain title; rows that meet a distinct note try again with a suffix from their url, once.
    What still collides is `slug_collision` with both squatters in `detail`.  Within the batch rows are taken in the
    order of `id_column`, as if written one at a time.  Round one is checkpointed because round two builds on its
    outcome three times; only the columns that decide are carried.
    """
    checkpoint_dir(incoming.sparkSession)
    asked = incoming.select(id_column, "title", "source_url").withColumn("slug", slugify(F.col("title")))
    first = _claim(asked, existing, id_column).checkpoint()
    settled = first.where(F.col("outcome") != "collision")
    suffixed = slug_suffix_title(F.col("title"), F.col("source_url"))
    again = first.where(F.col("outcome") == "collision").select(
        id_column, "source_url", F.col("title").alias("first_title"), F.col("blocked_by").alias("first_blocked_by"),
        suffixed.alias("title"), slugify(suffixed).alias("slug"),
    )
    arxiv = arxiv_id_from_url(F.col("source_url"))
    written = settled.where(F.col("outcome") == "created").select(
        F.col(id_column).cast("string").alias("note_id"), "slug",
        F.when(arxiv.isNotNull(), F.array(F.concat(F.lit("arxiv-id:"), arxiv)))
        .otherwise(F.array(F.lit("written"))).alias("tags"),
        "source_url", F.lit("written").alias("body"),
    )
    # a reclaimed note is gone by now
    reclaimed = settled.select(F.col("reclaimed_id").cast("string").alias("note_id")).where("note_id IS NOT NULL")
    stored = existing.select(F.col("note_id").cast("string").alias("note_id"), "slug", "tags", "source_url", "body")
    second = _claim(again, stored.join(reclaimed, "note_id", "left_anti").unionByName(written), id_column)
    unresolved = F.col("outcome") == "collision"
    head = [id_column, "source_url", "title", "slug"]
    done = settled.select(*head, F.col("outcome").alias("status"),
                          F.col("reclaimed_id").cast("string").alias("reclaimed_id"), F.lit("").alias("detail"))
    retried = second.select(
        *head, F.when(unresolved, "slug_collision").otherwise(F.col("outcome")).alias("status"), "reclaimed_id",
        F.when(unresolved, collision_detail(
            F.col("first_blocked_by"), F.col("first_title"), F.col("blocked_by"), F.col("title"), F.lit("")))
        .otherwise("").alias("detail"),
    )
    return done.unionByName(retried)


def fit_content(
    base_len: Column, full_text_len: Column, tier3_len: Column, exists: Column, limit: int
) -> dict[str, Column]:
    """The size ladder: whole, without full text, and for stored notes also without the deep sections.

    Returns `fit`, `keep_full_text`, `keep_tier3`, `add_repair_flag`, `status`.
    """
    whole = base_len + full_text_len + tier3_len <= limit
    no_text = base_len + tier3_len <= limit
    tier1_only = exists & (base_len <= limit)
    fit = (
        F.when(whole, "whole").when(no_text, "no_full_text").when(tier1_only, "tier1_only").otherwise("skipped")
    )
    return {
        "fit": fit,
        "keep_full_text": fit == "whole",
        "keep_tier3": fit.isin("whole", "no_full_text"),
        "add_repair_flag": fit == "tier1_only",
        "status": F.when(fit == "skipped", "content_too_large_skipped").when(exists, "updated").otherwise("created"),
    }


#: what a note says, besides title, tags and url
CONTENT = ("summary", "full_text", "tier1", "tier3", "user_notes")


def note_body(columns: list[str]) -> Column:
    """All content of a note as one text, from those of its content columns that a frame has."""
    shown = [F.to_json(c) if c in ("tier1", "tier3") else F.col(c) for c in CONTENT if c in columns]
    return F.concat_ws("\n", *[F.when(c != "{}", c) for c in shown]) if shown else F.lit("")


def trimmed(rows: DataFrame, limit: int, exists: Column, vocab: TagVocabulary = TAGS) -> DataFrame:
    """Apply the size ladder: the columns it drops are nulled, the repair flag is added, and `fit` says how far it went.

    Rows that do not fit at all (`skipped`) come back unchanged.
    """
    def size(column: str) -> Column:
        if column not in rows.columns:
            return F.lit(0)
        text = F.to_json(column) if column in ("tier1", "tier3") else F.col(column)
        return F.coalesce(F.length(text), F.lit(0))

    base = size("title") + size("summary") + size("tier1") + size("user_notes")
    ladder = fit_content(base, size("full_text"), size("tier3"), exists, limit)
    df = rows.withColumn("fit", ladder["fit"])
    skipped = F.col("fit") == "skipped"
    for column, keep in (("full_text", F.col("fit") == "whole"),
                         ("tier3", F.col("fit").isin("whole", "no_full_text"))):
        if column in rows.columns:
            df = df.withColumn(column, F.when(keep | skipped, F.col(column)))
    flagged = F.array_union("tags", F.array(F.lit(vocab.repair_needed)))
    return df.withColumn("tags", F.when(F.col("fit") == "tier1_only", flagged).otherwise(F.col("tags")))


def upsert_notes(existing: DataFrame, incoming: DataFrame, key: str = "source_url", vocab: TagVocabulary = TAGS,
                 content_limit: int | None = None, retry_conflicts: bool = True) -> tuple[DataFrame, DataFrame]:
    """(new store, write results) of one batch: what `upsert_changes` writes and takes away, applied to the store."""
    written, gone, results = upsert_changes(existing, incoming, key, vocab, content_limit, retry_conflicts)
    old = with_normalised_url(existing, key, key).withColumn(key, F.nullif(key, F.lit("")))
    store = written.unionByName(
        old.join(written.select(key), key, "left_anti").join(gone, "note_id", "left_anti").select(*existing.columns))
    return store, results


def upsert_changes(existing: DataFrame, incoming: DataFrame, key: str = "source_url", vocab: TagVocabulary = TAGS,
                   content_limit: int | None = None, retry_conflicts: bool = True
                   ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(written notes, ids of notes taken away, write results) of one batch, as if its rows were written one at a time
    in id order.

    Incoming rows carry item_id, profile, title, score, reason, tags, user_notes, any content columns of the store, and
    optionally expected_version.  Each gets one result (profile, item_id, status, detail).  Rows without title or url
    are `invalid_input`.  Known urls are merged into their notes, which keep title and slug: `updated`.  New urls go
    through slug collision handling; the first row of a url is `created` and later ones `updated`, or all of them are
    `duplicate` or `slug_collision`.  A row that expects another version than the stored one is merged into the stored
    one all the same, or, without `retry_conflicts`, left out as `version_conflict`.  With a `content_limit` the size
    ladder is applied; notes that still do not fit stay as they were (`content_too_large_skipped`).
    """
    checkpoint_dir(incoming.sparkSession)
    named = ["profile", F.col("item_id").cast("string").alias("item_id")]
    valid = (F.coalesce(F.col(key), F.lit("")) != "") & (F.coalesce(F.col("title"), F.lit("")) != "")
    results = incoming.where(~valid).select(
        *named, F.lit("invalid_input").alias("status"), F.lit("title or source_url is empty").alias("detail"))
    rows = with_normalised_url(incoming.where(valid), key, key)
    old = with_normalised_url(existing, key, key).withColumn(key, F.nullif(key, F.lit("")))
    if "expected_version" in incoming.columns:
        now = old.where(F.col(key).isNotNull()).groupBy(key).agg(F.max("version").alias("_version"))
        rows = rows.join(now, key, "left")
        stale = F.coalesce(F.col("expected_version") != F.col("_version"), F.lit(False))
        if not retry_conflicts:
            results = results.unionByName(rows.where(stale).select(
                *named, F.lit("version_conflict").alias("status"),
                F.concat(F.lit("stored version "), F.col("_version").cast("string")).alias("detail")))
            rows = rows.where(~stale)
        rows = rows.drop("expected_version", "_version")
    good = combine_incoming(rows, key).checkpoint()
    fresh = good.join(old.select(key), key, "left_anti")
    outcomes = resolve_collisions(
        fresh.select("item_id", "title", F.col(key).alias("source_url")),
        # whether a body is blank is all that counts, so its first character stands for it
        old.select("note_id", "slug", "tags", F.col(key).alias("source_url"),
                   F.substring(F.trim(note_body(old.columns)), 1, 1).alias("body"))
    ).withColumnRenamed("source_url", key).drop("item_id").checkpoint()
    creates = outcomes.where(F.col("status") == "created").select(
        key, F.col("title").alias("_title"), F.col("slug").alias("_slug"), "reclaimed_id")
    # whole rows are moved once: known urls keep the title they bring, new ones take the one their slug is of
    allowed = old.select(key).distinct().withColumn("_title", F.lit(None).cast("string")).unionByName(
        creates.select(key, "_title"))
    writes = good.join(allowed, key).withColumn("title", F.coalesce("_title", "title")).select(*good.columns)
    writes = writes.withColumn("confidence", F.lit(0.0)).withColumn("version", F.lit(0).cast("bigint"))
    merged = merge_notes(old.join(writes.select(key), key, "left_semi"), writes, key, vocab)
    # identity, and stored columns the incoming rows know nothing of
    rest = [c for c in existing.columns if c not in merged.columns and c != "slug"]
    kept = old.where(F.col(key).isNotNull()).select(
        key, *rest, F.col("slug").alias("_old_slug"), F.col("title").alias("_old_title"))
    touched = (
        merged.join(kept, key, "left").join(creates.select(key, "_slug"), key, "left")
        .withColumn("note_id", F.coalesce("note_id", F.substring(F.sha2(F.col(key), 256), 1, 32)))
        .withColumn("title", F.coalesce("_old_title", "title"))
        .withColumn("slug", F.coalesce("_old_slug", "_slug", slugify(F.col("title")))).withColumn("fit", F.lit("whole"))
    )
    if content_limit is not None:
        touched = trimmed(touched, content_limit, F.col("status") == "updated", vocab)
    touched = touched.select(*existing.columns, "fit", F.col("status").alias("_status")).checkpoint()
    written = touched.where("fit <> 'skipped'")
    gone = creates.join(written.select(key), key, "left_semi").where(F.col("reclaimed_id").isNotNull()).select(
        F.col("reclaimed_id").alias("note_id"))
    # what became of each url, and of each row that brought it
    by_url = touched.select(
        key, F.when(F.col("fit") == "skipped", "content_too_large_skipped").otherwise(F.col("_status")).alias("status"),
        F.when(F.col("fit") != "whole", F.col("fit")).otherwise("").alias("detail")
    ).unionByName(outcomes.where(F.col("status") != "created").select(key, "status", "detail"))
    first = good.select(key, F.col("item_id").alias("_first"))
    firsts = rows.join(first, key).where(F.col("item_id") == F.col("_first")).groupBy(key).agg(
        F.min("profile").alias("_by")).join(first, key)
    later = (F.col("item_id") != F.col("_first")) | ~F.col("profile").eqNullSafe(F.col("_by"))
    each = rows.select(key, "profile", "item_id").join(firsts, key).join(by_url, key).select(
        *named, F.when(later & (F.col("status") == "created"), "updated").otherwise(F.col("status")).alias("status"),
        "detail")
    return written.select(*existing.columns), gone, results.unionByName(each)


def sweep_conflict_merge(pending: DataFrame, stored: DataFrame, vocab: TagVocabulary = TAGS) -> DataFrame:
    """Repair rows whose expected version is stale: tags and user notes are merged, relevance and edits stay.

    `conflict` marks them; a caller that meets a second conflict stops the sweep.
    """
    now = stored.select("note_id", F.col("version").alias("_v"), F.col("tags").alias("_t"),
                        F.col("user_notes").alias("_u"))
    stale = F.col("expected_version") != F.col("_v")
    return (
        pending.join(now, "note_id", "left")
        .withColumn("conflict", F.coalesce(stale, F.lit(False)))
        .withColumn("tags", F.when(F.col("conflict"), merge_tags(F.col("_t"), F.col("tags"), vocab))
                    .otherwise(F.col("tags")))
        .withColumn("user_notes", F.when(F.col("conflict"), F.coalesce("_u", "user_notes"))
                    .otherwise(F.col("user_notes")))
        .withColumn("expected_version", F.coalesce("_v", "expected_version"))
        .drop("_v", "_t", "_u")
    )


def confirmed_deletes(squatters: DataFrame, confirmed: DataFrame, notes: DataFrame,
                      vocab: TagVocabulary = TAGS) -> DataFrame:
    """Delete plan: each confirmed id as `delete`, `not_ours` or `unknown`."""
    listed = squatters.select("doc_id").distinct().withColumn("_listed", F.lit(True))
    owned = notes.select(F.col("note_id").alias("doc_id"), has_tag(F.col("tags"), vocab.ingested_by).alias("_ours"))
    return (
        confirmed.select("doc_id").distinct().join(listed, "doc_id", "left").join(owned, "doc_id", "left")
        .select(
            "doc_id",
            F.when(F.col("_listed").isNull(), "unknown").when(F.coalesce("_ours", F.lit(False)), "delete")
            .otherwise("not_ours").alias("action"),
        )
    )

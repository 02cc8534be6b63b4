"""Tag arrays: predicates, merging, and the tag list of a new note."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner.vocabulary import FULL_TEXT, NOTE_SCHEMA_VERSION, OWNED_PREFIXES, TAGS, TagVocabulary

STRINGS = "array<string>"


def no_tags() -> Column:
    return F.array().cast(STRINGS)


def has_tag(tags: Column, tag: str | Column) -> Column:
    return F.coalesce(F.array_contains(tags, tag), F.lit(False))


def has_prefix(tags: Column, prefix: str) -> Column:
    return F.coalesce(F.exists(tags, lambda t: t.startswith(prefix)), F.lit(False))


def first_tag(tags: Column, prefix: str) -> Column:
    """Value behind the first tag with this prefix, null without one."""
    hit = F.get(F.filter(tags, lambda t: t.startswith(prefix)), F.lit(0))
    return F.substr(hit, F.lit(len(prefix) + 1))


def distinct_keep_order(values: Column) -> Column:
    return F.array_distinct(F.array_compact(values))


def tag_union(a: Column, b: Column) -> Column:
    return F.array_union(a, b)


def tag_except(a: Column, b: Column) -> Column:
    return F.array_except(a, b)


def tag_intersect(a: Column, b: Column) -> Column:
    return F.array_intersect(a, b)


def source_family(source: Column, tags: Column) -> Column:
    """`arxiv` or `rss` from the source column, else from the first `source:` tag; `unknown` without either."""
    name = F.coalesce(F.nullif(source, F.lit("")), first_tag(tags, "source:"))
    return F.when(name == "arxiv", "arxiv").when(name.isNotNull() & (name != ""), "rss").otherwise("unknown")


def is_owned(tag: Column, vocab: TagVocabulary = TAGS) -> Column:
    """Whether the tag is rewritten by every pass rather than preserved."""
    owned = tag.isin(*vocab.owned_exact)
    for prefix in OWNED_PREFIXES:
        owned = owned | tag.startswith(prefix)
    return owned


def rejected_profiles(*tag_lists: Column, vocab: TagVocabulary = TAGS) -> Column:
    prefix = vocab.rejected_prefix
    marks = F.filter(F.concat(*tag_lists), lambda t: t.startswith(prefix))
    return F.array_distinct(F.transform(marks, lambda t: F.substr(t, F.lit(len(prefix) + 1))))


def merge_tags(existing: Column, new: Column, vocab: TagVocabulary = TAGS) -> Column:
    """Tags of a rewritten note.

    Owned tags come from `new`; profile tags are united and lose the rejected profiles; rejection marks are united;
    whatever else was on the note stays.  A new tag that is none of these is not added.
    """
    existing, new = F.coalesce(existing, no_tags()), F.coalesce(new, no_tags())
    both = F.concat(existing, new)
    blocked = F.transform(rejected_profiles(existing, new, vocab=vocab), lambda p: F.concat(F.lit("profile:"), p))
    owned = F.filter(new, lambda t: is_owned(t, vocab))
    profiles = F.array_sort(F.array_except(F.filter(both, lambda t: t.startswith("profile:")), blocked))
    marks = F.array_sort(F.array_distinct(F.filter(both, lambda t: t.startswith(vocab.rejected_prefix))))
    external = F.filter(
        existing,
        lambda t: ~is_owned(t, vocab) & ~t.startswith("profile:") & ~t.startswith(vocab.rejected_prefix),
    )
    return F.concat(owned, profiles, marks, external)


RELEVANCE = "array<struct<profile:string,score:int,reason:string>>"


def _entries(col: Column) -> Column:
    return F.coalesce(col, F.array().cast(RELEVANCE))


def merge_relevance_union(old: Column, new: Column, tags: Column, vocab: TagVocabulary = TAGS) -> Column:
    """New entries of profiles that are not rejected, then each old entry whose profile is not there yet."""
    blocked = rejected_profiles(F.coalesce(tags, no_tags()), vocab=vocab)
    fresh = F.filter(_entries(new), lambda e: ~F.array_contains(blocked, e["profile"]))
    taken = F.transform(fresh, lambda e: e["profile"])
    return F.concat(fresh, F.filter(_entries(old), lambda e: ~F.array_contains(taken, e["profile"])))


def relevance_for_rewrite(old: Column, new: Column, tags: Column, vocab: TagVocabulary = TAGS) -> Column:
    """As the union, but old entries survive only for rejected profiles."""
    blocked = rejected_profiles(F.coalesce(tags, no_tags()), vocab=vocab)
    fresh = F.filter(_entries(new), lambda e: ~F.array_contains(blocked, e["profile"]))
    return F.concat(fresh, F.filter(_entries(old), lambda e: F.array_contains(blocked, e["profile"])))


def max_profile_score(relevance: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(relevance, lambda e: e["score"])), F.lit(0))


def confidence(existing: Column, max_score: Column) -> Column:
    return F.greatest(existing, max_score / F.lit(10.0))


def note_tags(top_level: Column, metadata: Column) -> Column:
    """Tags at the top level, else under `metadata`."""
    return F.coalesce(top_level, metadata, no_tags())


def note_url(top_level: Column, metadata: Column) -> Column:
    return F.coalesce(F.nullif(top_level, F.lit("")), F.nullif(metadata, F.lit("")))


def _flags(rows: list[tuple[Column | None, Column]]) -> Column:
    return F.array_distinct(
        F.array_compact(F.array(*[value if cond is None else F.when(cond, value) for cond, value in rows]))
    )


def build_tags(
    kind: str,
    *,
    profile: Column,
    categories: Column | None = None,
    arxiv_id: Column | None = None,
    source_tag: Column | None = None,
    feed_slug: Column | None = None,
    archive_missing: Column,
    archive_terminal: Column | None = None,
    text_tag: Column | None = None,
    has_full_text: Column,
    has_tier3: Column,
    repair_flag: Column,
    tier2_terminal: Column,
    tier3_terminal: Column,
    vocab: TagVocabulary = TAGS,
) -> Column:
    """Tag list of a fresh note; `kind` is `arxiv` or `rss`.  A feed note carries no `text:` tag."""
    lit = F.lit
    schema = (None, lit(f"schema:{NOTE_SCHEMA_VERSION}"))
    ours = (None, lit(vocab.ingested_by))
    mine = (None, F.concat(lit("profile:"), profile))
    missing = (archive_missing, lit(vocab.archive_missing))
    tail = [
        (has_full_text, lit(FULL_TEXT)),
        (archive_missing, lit(vocab.repair_needed)),
        (has_tier3, lit(vocab.deep_extracted)),
        (repair_flag, lit(vocab.repair_needed)),
        (tier2_terminal, lit(vocab.stage_terminal("tier2"))),
        (tier3_terminal, lit(vocab.stage_terminal("tier3"))),
    ]
    if kind == "rss":
        head = [mine, (None, F.concat(lit("source:"), source_tag)), (None, F.concat(lit("feed-slug:"), feed_slug)),
                ours, schema, missing]
        return _flags(head + tail)
    head = _flags([mine, (None, F.concat(lit("arxiv-id:"), arxiv_id)), (None, lit("source:arxiv")), ours, schema])
    cats = F.transform(F.coalesce(categories, no_tags()), lambda c: F.concat(lit("cat:"), c))
    rest = _flags(
        [missing, (lit(False) if archive_terminal is None else archive_terminal, lit(vocab.archive_terminal)),
         (text_tag.isNotNull(), text_tag)] + tail
    )
    return F.concat(head, cats, rest)


def summary_text(kind: str, *, tier1_attempted: Column, tier1_ok: Column, abstract: Column,
                 extracted: Column | None = None) -> Column:
    """Plain summary of a note: blank where the structured one was tried and failed."""
    plain = abstract if kind == "arxiv" or extracted is None else F.coalesce(F.nullif(extracted, F.lit("")), abstract)
    return F.when(tier1_attempted & ~tier1_ok, F.lit("")).otherwise(plain)


def archive_problem(archive_path: Column, tags: Column, vocab: TagVocabulary = TAGS) -> Column:
    """What makes a note unwritable: an archive path next to the missing tag, or no ingester tag."""
    return F.when(~has_tag(tags, vocab.ingested_by), "missing_ingested_by").when(
        archive_path.isNotNull() & has_tag(tags, vocab.archive_missing), "path_and_archive_missing"
    )

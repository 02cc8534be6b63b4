"""Markdown form of notes, both ways.  Notes stay structured in tables; text exists only at the edges."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.tags import no_tags
from gleaner.functions.text import format_confidence, one_line
from gleaner.functions.urls import normalise_url
from gleaner.vocabulary import TAGS, TagVocabulary

_EMPTY_NOTES = "## User Notes\n"


def bullets(values: Column) -> Column:
    return F.array_join(F.transform(F.coalesce(values, no_tags()), lambda v: F.concat(F.lit("- "), v, F.lit("\n"))), "")


def note_header(source_url: Column, tags: Column, confidence: Column, vocab: TagVocabulary = TAGS) -> Column:
    """The block between the fences."""
    tag_lines = F.when(F.size(tags) == 0, "tags: []").otherwise(
        F.concat(F.lit("tags:\n"), F.array_join(F.transform(tags, lambda t: F.concat(F.lit("  - "), t)), "\n"))
    )
    return F.concat_ws(
        "\n",
        F.lit("note_type: summary"),
        F.lit(f"namespace: {vocab.namespace}"),
        F.concat(F.lit("source_url: "), normalise_url(source_url)),
        tag_lines,
        F.concat(F.lit("confidence: "), format_confidence(confidence)),
    )


def relevance_body(entries: Column) -> Column:
    return F.array_join(
        F.transform(
            entries,
            lambda e: F.concat(F.lit("### "), e["profile"], F.lit("\nScore: "), e["score"].cast("string"),
                               F.lit("/10\n"), F.coalesce(e["reason"], F.lit(""))),
        ),
        "\n\n",
    )


def repair_keys(stage: str) -> tuple[str, str, str]:
    last = "last_kind" if stage == "archive" else "last_stage"
    return f"{stage}_attempts", f"{stage}_{last}", f"{stage}_last_error"


def repair_body(repair: Column) -> Column:
    """Bullets of the attempt counters."""
    lines = []
    for stage in ("tier2", "tier3", "archive"):
        attempts, last, error = repair_keys(stage)
        lines.append(F.concat(F.lit(f"- {attempts}: "), F.coalesce(repair[attempts], F.lit(0)).cast("string")))
        for key in (last, error):
            lines.append(F.concat(F.lit(f'- {key}: "'), one_line(F.coalesce(repair[key], F.lit(""))), F.lit('"')))
    return F.concat(F.concat_ws("\n", *lines), F.lit("\n"))


def render_note(
    *,
    title: Column,
    source_url: Column,
    tags: Column,
    confidence: Column,
    archive_path: Column,
    summary: Column,
    tier1: Column,
    full_text: Column,
    tier3: Column,
    relevance: Column,
    repair: Column,
    user_notes: Column,
    keywords: Column | None = None,
    vocab: TagVocabulary = TAGS,
) -> Column:
    """The whole note in its fixed section order.  `potential_connections` is never shown."""
    lit = F.lit
    words = F.coalesce(keywords, no_tags()) if keywords is not None else no_tags()
    plain = F.concat(
        summary, F.when(F.size(words) > 0, F.concat(lit("\n\nKeywords: "), F.array_join(words, ", "))).otherwise("")
    )
    structured = F.concat(
        lit("## Summary\n### Contributions\n"), bullets(tier1["contributions"]),
        lit("\n### Method\n"), tier1["method"], lit("\n\n### Result\n"), tier1["result"],
        lit("\n\n### Relevance\n"), tier1["relevance"], lit("\n"),
    )
    summary_part = (
        F.when(tier1.isNotNull(), structured)
        .when(F.coalesce(summary, lit("")) != "", F.concat(lit("## Summary\n"), plain, lit("\n")))
        .otherwise("")
    )
    text_part = F.when(
        F.coalesce(full_text, lit("")) != "", F.concat(lit("\n## Full Text\n"), full_text, lit("\n"))
    ).otherwise("")
    deep_part = F.when(
        tier3.isNotNull(),
        F.concat(
            lit("\n## Claims\n"), bullets(tier3["claims"]),
            lit("\n## Datasets & Benchmarks\n"), bullets(tier3["datasets"]),
            lit("\n## Builds On\n"), bullets(tier3["builds_on"]),
            lit("\n## Open Questions\n"), bullets(tier3["open_questions"]),
        ),
    ).otherwise("")
    repair_part = F.when(repair.isNotNull(), F.concat(lit("\n## Repair\n"), repair_body(repair))).otherwise("")
    body = relevance_body(relevance)
    relevance_part = F.concat(
        lit("\n## Profile Relevance\n"), F.when(body != "", F.concat(body, lit("\n"))).otherwise("")
    )
    return F.concat(
        lit("---\n"), note_header(source_url, tags, confidence, vocab), lit("\n---\n# "), title,
        lit("\n\n## Archive\n"),
        F.when(archive_path.isNotNull(), F.concat(lit("path: "), archive_path, lit("\n"))).otherwise(""),
        lit("\n"), summary_part, text_part, deep_part, repair_part, relevance_part,
        lit("\n"), F.coalesce(user_notes, lit(_EMPTY_NOTES)),
    )


# ---- reading ------------------------------------------------------------------------------------------------------

_CLOSING_FENCE = r"\r?\n---[ \t]*(?=\r?\n|\z)"
_TITLE_LINE = r"(?m)^[ \t]*# [^\n]*(?:\n|\z)"
_BEFORE_USER_NOTES = r"\n(?=## User Notes[ \t]*(?:\r?\n|\z))"


def split_note(files: DataFrame, text: str = "text") -> DataFrame:
    """Add `front`, `title`, `sections`, `user_notes` and `note_error` to rows of note texts.

    The text is cut once at each boundary - closing fence, title line, user notes - and the pieces are columns, so no
    pattern runs over the whole text more often than that.  User notes stay byte for byte.
    """
    fenced = files.withColumn("_f", F.split(F.col(text), _CLOSING_FENCE, 2)).withColumn(
        "_rest", F.regexp_replace(F.get("_f", F.lit(1)), r"\A\r?\n", ""))
    titled = (
        fenced.withColumn("_t", F.split("_rest", _TITLE_LINE, 2))
        .withColumn("_line", F.substring("_rest", F.length(F.get("_t", F.lit(0))) + 1,
                                         F.length("_rest") - F.length(F.get("_t", F.lit(0))) - F.length(F.get("_t", F.lit(1)))))
        .withColumn("_b", F.split(F.concat(F.lit("\n"), F.get("_t", F.lit(1))), _BEFORE_USER_NOTES, 2))
    )
    no_fence = ~F.col(text).startswith("---") | (F.size("_f") < 2)
    return titled.select(
        *files.columns,
        F.regexp_replace(F.get("_f", F.lit(0)), r"\A---[^\n]*\n?", "").alias("front"),
        F.regexp_replace("_line", r"\A[ \t]*# |\s+\z", "").alias("title"),
        _sections(F.get("_b", F.lit(0))).alias("sections"),
        F.get("_b", F.lit(1)).alias("user_notes"),
        F.when(no_fence, "no_front_matter").when(F.size("_t") < 2, "no_title").alias("note_error"),
    )


def _sections(body: Column) -> Column:
    """Array of (heading, body) in document order."""
    parts = F.filter(F.split(body, r"\n(?=## )"), lambda p: p.startswith("## "))
    return F.transform(
        parts,
        lambda p: F.struct(
            F.rtrim(F.regexp_extract(p, r"\A## ([^\r\n]*)", 1)).alias("heading"),
            F.regexp_replace(F.regexp_extract(p, r"(?s)\A[^\n]*\n(.*)\z", 1), r"[\r\n]+\z", "").alias("body"),
        ),
    )


def section_body(parts: Column, heading: str) -> Column:
    """Body of the first section with this heading, null without one."""
    return F.get(F.filter(parts, lambda p: p["heading"] == heading), F.lit(0))["body"]


def header_value(front: Column, key: str) -> Column:
    return F.nullif(F.trim(F.regexp_extract(front, rf"(?m)^{key}:[ \t]*([^\r\n]*)", 1)), F.lit(""))


def header_tags(front: Column) -> Column:
    """The list items of the header: its only list is the tags."""
    items = F.filter(F.split(front, r"\r?\n"), lambda t: t.rlike(r"^[ \t]+- "))
    return F.transform(items, lambda t: F.trim(F.regexp_replace(t, r"^[ \t]+- ", "")))


def stored_archive_path(archive_body: Column) -> Column:
    """(path, error) of an archive section: one `path:` line or nothing."""
    text = F.trim(F.regexp_replace(F.coalesce(archive_body, F.lit("")), r"^\s+|\s+$", ""))
    path = F.nullif(F.trim(F.regexp_extract(text, r"\Apath:([^\r\n]*)\z", 1)), F.lit(""))
    return F.struct(
        path.alias("path"),
        F.when((text != "") & ~text.rlike(r"\Apath:[^\r\n]*\z"), "bad_archive_section").alias("error"),
    )


def parse_relevance(body: Column) -> Column:
    """`### profile / Score: n/10 / reason` blocks to an array of entries; score 0 where it is missing."""
    blocks = F.filter(F.split(F.concat(F.lit("\n"), body), r"\n(?=### )"), lambda b: b.startswith("### "))

    def entry(block: Column) -> Column:
        rest = F.regexp_extract(block, r"(?s)\A[^\n]*\n(.*)\z", 1)
        score = F.regexp_extract(rest, r"(?m)^Score:\s*([0-9]+)/10", 1).try_cast("int")
        after = F.regexp_extract(rest, r"(?s)(?:\A|.*?\n)Score:\s*[0-9]+/10[^\n]*\n(.*)\z", 1)
        reason = F.regexp_replace(F.regexp_replace(after, r"\r", ""), r"(?m)^Score:\s*[0-9]+/10[^\n]*(?:\n|\z)", "")
        return F.struct(
            F.trim(F.regexp_extract(block, r"\A### ([^\r\n]*)", 1)).alias("profile"),
            F.coalesce(score, F.lit(0)).alias("score"),
            F.regexp_replace(reason, r"\A\s+|\s+\z", "").alias("reason"),
        )

    return F.transform(blocks, entry)


def parse_repair(body: Column) -> Column:
    """Attempt counters; malformed numbers are 0, unknown keys are ignored."""
    fields = []
    for stage in ("tier2", "tier3", "archive"):
        attempts, last, error = repair_keys(stage)

        def value(key: str) -> Column:
            raw = F.trim(F.regexp_extract(F.coalesce(body, F.lit("")), rf"(?m)^- {key}:[ \t]*([^\r\n]*)", 1))
            return F.regexp_replace(raw, r'^"(.*)"$', "$1")

        fields += [
            F.coalesce(value(attempts).try_cast("int"), F.lit(0)).alias(attempts),
            F.nullif(value(last), F.lit("")).alias(last),
            F.nullif(value(error), F.lit("")).alias(error),
        ]
    return F.struct(*fields)


def parse_bullets(body: Column) -> Column:
    lines = F.split(F.regexp_replace(F.coalesce(body, F.lit("")), r"\r", ""), "\n")
    return F.transform(F.filter(lines, lambda t: t.startswith("- ")), lambda t: F.substr(t, F.lit(3)))


# ---- editing ------------------------------------------------------------------------------------------------------

#: before which sections a new one goes, by heading; after all others if none is there
_PLACES = {"Repair": ("Profile Relevance", "User Notes"), "Profile Relevance": ("User Notes",)}
_PIECE = "array<struct<heading:string,text:string>>"


def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with the value computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def pieces(text: Column) -> Column:
    """A note as an array of (heading, text) that `joined_pieces` puts together again byte for byte.

    What stands before the first section has no heading.  From `## User Notes` on everything is one piece, whatever its
    lines look like.
    """
    def heading(part: Column) -> Column:
        return F.when(part.startswith("## "), F.trim(F.regexp_extract(part, r"\A## ([^\r\n]*)", 1)))

    def take(done: Column, part: Column) -> Column:
        last = F.element_at(done, -1)
        in_notes = F.coalesce(last["heading"] == "User Notes", F.lit(False))
        longer = F.struct(last["heading"].alias("heading"), F.concat(last["text"], F.lit("\n"), part).alias("text"))
        return F.when(in_notes, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))).otherwise(
            F.concat(done, F.array(F.struct(heading(part).alias("heading"), part.alias("text")))))

    def folded(parts: Column) -> Column:
        first = F.array(F.struct(heading(F.get(parts, F.lit(0))).alias("heading"), F.get(parts, F.lit(0)).alias("text")))
        rest = F.filter(parts, lambda _, i: i > 0)
        return F.aggregate(rest, first.cast(_PIECE), lambda done, part: take(done, part).cast(_PIECE))

    return _once(F.split(text, r"\n(?=## )", -1), folded)


def joined_pieces(parts: Column) -> Column:
    return F.array_join(F.transform(parts, lambda p: p["text"]), "\n")


def set_section(text: Column, heading: str, body: Column) -> Column:
    """The note with this body in its first section of the heading, added at its place if there is none and taken out
    for a null body.  All other bytes stay as they are."""
    def edited(parts: Column) -> Column:
        at = F.array_position(F.transform(parts, lambda p: F.coalesce(p["heading"], F.lit(""))), heading).cast("int")
        new = F.array(F.struct(F.lit(heading).alias("heading"), F.concat(
            F.lit(f"## {heading}\n"), body).alias("text"))).cast(_PIECE)
        without = F.filter(parts, lambda p, i: i != at - 1)
        put = F.filter(F.transform(F.array(*[F.lit(p) for p in _PLACES.get(heading, ("User Notes",))]), lambda place:
                       F.array_position(F.transform(parts, lambda p: F.coalesce(p["heading"], F.lit(""))), place)),
                       lambda i: i > 0)
        before = F.when(at > 0, at).otherwise(F.coalesce(F.get(put, F.lit(0)).cast("int"), F.size(parts) + 1)) - 1
        rest = F.filter(without, lambda _, i: i >= before)
        return F.when(body.isNull(), without).otherwise(F.concat(F.filter(without, lambda _, i: i < before), new, rest))

    return _once(pieces(text), lambda parts: joined_pieces(edited(parts)))


def with_repair(text: Column, repair: Column) -> Column:
    """The note with these attempt counters; without the section where they are null."""
    return set_section(text, "Repair", F.when(repair.isNotNull(), repair_body(repair)))


def with_relevance(text: Column, relevance: Column) -> Column:
    """The note with these scores of profiles."""
    body = relevance_body(relevance)
    return set_section(text, "Profile Relevance", F.when(body != "", F.concat(body, F.lit("\n"))).otherwise(""))

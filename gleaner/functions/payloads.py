"""JSON in and out: model responses, store envelopes, notification payloads."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner.functions.binding import let
from gleaner.functions.text import strip
from gleaner.schemas import CHAT_RESPONSE, SCORE_RESPONSE

ELEMENT_CHARS = 500
BODY_EXCERPT = 500
TIER1_DDL = "contributions ARRAY<STRING>, method STRING, result STRING, relevance STRING"
_LISTS = ("claims", "datasets", "builds_on", "open_questions", "potential_connections")
MESSAGE_KEYS = ("reason", "detail", "error", "message")


def chat_content(response: Column) -> Column:
    """Text of the first choice of a chat completion."""
    return F.get(F.from_json(response, CHAT_RESPONSE)["choices"], F.lit(0))["message"]["content"]


def parse_scores(content: Column) -> Column:
    """Array of (id, score, tags, reason); null when the text is not such an object."""
    return F.from_json(content, SCORE_RESPONSE)["results"]


def parse_tier1(content: Column) -> Column:
    """Structured summary, null unless it has one to six contributions and all three texts."""
    def check(v: Column) -> Column:
        ok = (
            F.size(v["contributions"]).between(1, 6)
            & F.forall(v["contributions"], lambda c: c.isNotNull())
            & v["method"].isNotNull() & v["result"].isNotNull() & v["relevance"].isNotNull()
        )
        return F.when(F.coalesce(ok, F.lit(False)), v)

    return let(F.from_json(content, TIER1_DDL), check)


def trim_cut(values: Column, limit: int = ELEMENT_CHARS) -> Column:
    return F.transform(values, lambda v: F.substring(strip(v), 1, limit))


def parse_tier3(content: Column) -> Column:
    """Deep extraction: 1..10 claims, other lists 0..10, each element a non-empty string of at most 500 characters."""
    def text(x: Column) -> Column:
        # a number, object or null where a string belongs makes the whole answer invalid
        return F.when(F.schema_of_variant(x) == "STRING", F.substring(strip(F.try_variant_get(x, "$", "string")), 1, ELEMENT_CHARS))

    def texts(v: Column) -> Column:
        return F.struct(*[
            F.transform(F.coalesce(v[k], F.array().cast("array<variant>")), text).alias(k) for k in _LISTS])

    def check(v: Column) -> Column:
        ok = F.size(v["claims"]) >= 1
        for k in _LISTS:
            ok = ok & (F.size(v[k]) <= 10) & F.forall(v[k], lambda x: F.coalesce(F.length(x) > 0, F.lit(False)))
        return F.when(F.coalesce(ok, F.lit(False)), v)

    parsed = F.from_json(content, ", ".join(f"{k} ARRAY<VARIANT>" for k in _LISTS))
    return let(let(parsed, texts), check)


def json_text(obj: Column, key: str) -> Column:
    """A non-empty string value of a variant object; values of other types do not count."""
    value = F.try_variant_get(obj, f"$.{key}", "variant")
    return F.when(
        F.schema_of_variant(value) == "STRING", F.nullif(F.try_variant_get(obj, f"$.{key}", "string"), F.lit("")))


def _first_text(obj: Column, keys: Sequence[str]) -> Column:
    return F.coalesce(*[json_text(obj, k) for k in keys], F.lit(""))


def first_non_empty(body: Column, keys: Sequence[str] = MESSAGE_KEYS) -> Column:
    """First non-empty string among the keys of a JSON object; empty without one."""
    return let(F.try_parse_json(body), lambda obj: _first_text(obj, keys))


#: fixed values: outcomes of a store write
WRITE_OK = ("created", "updated")


def write_outcome(envelope: Column) -> Column:
    """(status, detail, note_id, excerpt) of a store's answer.

    The detail depends on the status; an answer with an unknown status and no message keeps an excerpt of its body.
    """
    def fields(obj: Column) -> Column:
        return F.struct(
            *[F.coalesce(json_text(obj, k), F.lit("")).alias(k)
              for k in ("status", "note_id", "reason", "existing_id", "message")],
            _first_text(obj, MESSAGE_KEYS).alias("said"),
        )

    def outcome(v: Column) -> Column:
        status = v["status"]
        silent = status.isin(*WRITE_OK, "duplicate", "content_too_large")
        known = silent | status.isin("invalid_input", "slug_collision", "version_conflict")
        some = lambda c: F.nullif(c, F.lit(""))
        detail = (
            F.when(silent, "")
            .when(status == "invalid_input", F.coalesce(some(v["reason"]), F.lit("unknown")))
            .when(status == "slug_collision", F.concat_ws(
                "; ", F.concat(F.lit("existing_id="), some(v["existing_id"])), some(v["message"])))
            .when(status == "version_conflict", v["note_id"])
            .otherwise(v["said"])
        )
        return F.struct(
            status.alias("status"), detail.alias("detail"),
            F.when(status.isin(*WRITE_OK) | ~known, v["note_id"]).otherwise("").alias("note_id"),
            F.when(~known & (v["said"] == ""), F.substring(envelope, 1, BODY_EXCERPT)).otherwise("").alias("excerpt"),
        )

    return let(let(F.try_parse_json(envelope), fields), outcome)


# ---- notifications ------------------------------------------------------------------------------------------------

QUIET_MESSAGE = "No new relevant content found today."  # fixed value


# The labels of the lines of a message, and the texts of a run without news.
def item_message(profile: Column, run_date: Column, item: Column, product: str = "gleaner") -> Column:
    """Text lines about one ingested item; `item` has title, score, url, reason, tags, related."""
    related = F.filter(item["related"], lambda r: F.coalesce(r, F.lit("")) != "")
    return F.concat_ws(
        "\n",
        F.lit(f"{product} ingested a document."),
        F.concat(F.lit("Profile: "), profile),
        F.concat(F.lit("Run date: "), run_date),
        F.concat(F.lit("Title: "), item["title"]),
        F.concat(F.lit("Score: "), item["score"].cast("string"), F.lit("/10")),
        F.concat(F.lit("URL: "), item["url"]),
        F.when(F.coalesce(item["reason"], F.lit("")) != "", F.concat(F.lit("Reason: "), item["reason"])),
        F.when(F.size(item["tags"]) > 0, F.concat(F.lit("Tags: "), F.array_join(item["tags"], ", "))),
        F.when(F.size(related) > 0, F.concat(F.lit("Related: "), F.array_join(related, ", "))),
    )


def digest_message(profile: Column, run_date: Column, checked: Column, ingested: Column, items: Column,
                   product: str = "gleaner") -> Column:
    """Text lines about a run; `items` is one page of (title, score, url)."""
    lines = F.array_join(
        F.transform(items, lambda i: F.concat(F.lit("- ["), i["score"].cast("string"), F.lit("/10] "), i["title"],
                                              F.lit(" ("), i["url"], F.lit(")"))), "\n")
    return F.concat_ws(
        "\n",
        F.lit(f"{product} run completed."),
        F.concat(F.lit("Profile: "), profile),
        F.concat(F.lit("Run date: "), run_date),
        F.concat(F.lit("Sources checked: "), checked.cast("string")),
        F.concat(F.lit("Ingested: "), ingested.cast("string")),
        F.when(F.size(items) > 0, F.concat(F.lit("Highlights:\n"), lines)).otherwise("No new relevant content found."),
    )


def payload_json(sink_type: Column, *, digest: Column, message: Column, item: Column, profile: Column, sink: Column,
                 product: str = "gleaner") -> Column:
    """Payload row by sink type: digest object, text with context, toast, or agent message."""
    toast = F.to_json(F.struct(
        F.lit("info").alias("type"),
        F.when(item["score"] >= 9, "high").otherwise("normal").alias("priority"),
        F.concat(F.lit(f"{product}: Score "), item["score"].cast("string"), F.lit("/10")).alias("title"),
        item["title"].alias("message"),
        F.concat(profile, F.lit(" | "), item["url"]).alias("detail"),
        F.lit(8).alias("display_time"),
    ))
    agent = F.to_json(F.struct(
        message.alias("message"), sink["sender_name"].alias("name"), sink["deliver"].alias("deliver"),
        F.nullif(sink["wake_mode"], F.lit("")).alias("wakeMode"), F.nullif(sink["channel"], F.lit("")).alias("channel"),
    ))
    text = F.to_json(F.struct(message.alias("text"), sink["context"].alias("context")), {"ignoreNullFields": "false"})
    return (
        F.when(sink_type == "digest", digest)
        .when(sink_type == "message", text)
        .when(sink_type == "toast", toast)
        .when(sink_type == "agent", agent)
    )

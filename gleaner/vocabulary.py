"""Fixed values shared by the operators: tags, stages, limits, thresholds."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class TagVocabulary:
    """State tags carry a namespace so that a store written under another one can be read as it is."""

    namespace: str = "gleaner"

    def state(self, name: str) -> str:
        return f"{self.namespace}:{name}"

    @property
    def repair_needed(self) -> str:
        return self.state("repair-needed")

    @property
    def archive_missing(self) -> str:
        return self.state("archive-missing")

    @property
    def archive_terminal(self) -> str:
        return self.state("archive-terminal")

    @property
    def deep_extracted(self) -> str:
        return self.state("deep-extracted")

    @property
    def text_terminal(self) -> str:
        return self.state("text-terminal")

    @property
    def rejected_prefix(self) -> str:
        return self.state("rejected:")

    @property
    def ingested_by(self) -> str:
        return f"ingested-by:{self.namespace}"

    def stage_terminal(self, stage: str) -> str:
        return self.state(f"{stage}-terminal")

    @property
    def owned_exact(self) -> tuple[str, ...]:
        return (
            FULL_TEXT, self.repair_needed, self.archive_missing, self.deep_extracted, self.text_terminal,
            self.stage_terminal("tier2"), self.stage_terminal("tier3"), self.archive_terminal,
        )


TAGS = TagVocabulary()

# fixed values
FULL_TEXT = "full-text"
TEXT_HTML, TEXT_PDF, TEXT_ABSTRACT = "text:html", "text:pdf", "text:abstract-only"
OWNED_PREFIXES = ("source:", "arxiv-id:", "cat:", "text:", "ingested-by:", "schema:")
NOTE_SCHEMA_VERSION = 1

ATTEMPT_CAP = 3
COUNTED_FAILURE_STAGES = ("parse", "validate", "oversize")
REPAIR_STAGES = ("archive", "tier2", "tier3")

LEDGER_WINDOW = 20
SCORE_BATCH = 25
REPAIR_LIMIT = 100
NEGATIVE_EXAMPLES = 20
RELATED_LIMIT = 5
BACKFILL_CONFIRM_LIMIT = 1000
MAX_DOWNLOAD_BYTES = 52_428_800
MIN_HTML_CHARS, MIN_ARTICLE_CHARS = 1000, 500
STRIP_TAGS = ("script", "iframe", "object", "embed")

THRESHOLDS = {
    "relevance": 7,
    "full_text": 8,
    "deep_extract": 9,
    "notify_immediate": 8,
    "edge_score": 0.75,
}

"""What a job can be asked to do."""

from __future__ import annotations

from dataclasses import dataclass, fields

from revtrail.plans.sinks import DEFAULT_MAX_CONTENT_SIZE


@dataclass(frozen=True)
class LoadOptions:
    """incremental: skip origins whose archived head is the log's, unaltered.
    check_revision: verify every n-th revision of a run (0: the last one only)
    from ``check_revision_from`` on.  max_content_size: larger contents are
    archived without data.  visit_date: of the archived visit.  origins:
    comma-separated, all if empty.  properties, externals: apply them to files and trees."""
    incremental: bool = True
    check_revision: int = 0
    check_revision_from: int = 0
    max_content_size: int = DEFAULT_MAX_CONTENT_SIZE
    visit_date: str = "1970-01-01"
    origins: str = ""
    properties: bool = True
    externals: bool = False

    @classmethod
    def parse(cls, words: list[str]) -> LoadOptions:
        """From ``name=value`` words; unknown names and unreadable values are errors."""
        kinds = {f.name: type(f.default) for f in fields(cls)}
        found = {}
        for word in words:
            name, sign, value = word.partition("=")
            if not sign or name not in kinds:
                raise ValueError(f"unknown option {word!r}")
            if kinds[name] is bool:
                if value not in ("true", "false"):
                    raise ValueError(f"{name} must be true or false")
                found[name] = value == "true"
            else:
                found[name] = kinds[name](value)
        return cls(**found)

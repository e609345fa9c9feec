"""Header and stop patterns of a language, as data."""

from __future__ import annotations

from dataclasses import dataclass

ABBREVIATIONS, TERMS = "abbreviations", "terms"


@dataclass(frozen=True)
class LanguagePack:
    """Patterns over normalised lines; keywords over lines without spaces."""

    headers: dict[str, tuple[str, ...]]
    keywords: dict[str, tuple[str, ...]]
    stops: tuple[str, ...]
    page_mark: str
    longest_header: int = 120
    longest_keyword_line: int = 80


# Patterns of Russian section headers.
RUSSIAN = LanguagePack(
    headers={
        ABBREVIATIONS: (
            r"перечень\s+сокращ", r"перечень\s+принятых\s+сокращ", r"список\s+сокращ", r"сокращени[яй]", r"условные\s+обознач", r"принятых\s+сокращ",
        ),
        TERMS: (
            r"термины\s+и\s+определ", r"термины,?\s+определ", r"термины\s+и\s+их\s+определ", r"глоссарий", r"определени[яй]\s+термин", r"термины\s*$", r"определени[яй]\s*$",
        ),
    },
    keywords={ABBREVIATIONS: ("сокращ", "обознач"), TERMS: ("термин", "определ", "глоссар")},
    stops=(
        r"содержание", r"введение", r"общие\s+полож", r"приложени[ея]", r"литератур", r"библиограф", r"список\s+источник", r"термины\s+и\s+определ",
        r"сокращени[яй]", r"перечень\s+сокращ", r"аннотация", r"реферат", r"оглавление", r"нормативн", r"гост\s+\d",
    ),
    page_mark="--- Страница {} ---",
)


def alternation(patterns: tuple[str, ...]) -> str:
    return "(?:" + "|".join(patterns) + ")"

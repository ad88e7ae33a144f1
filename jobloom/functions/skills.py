"""Whole-word dictionary search over free text in one regular-expression pass."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, functions as F

from jobloom.functions.common import as_col, text_or_empty

# ---- fixed values: the published skill dictionary ----------------------------
TECH_SKILLS = (
    "python", "sql", "spark", "aws", "airflow", "kafka", "docker", "kubernetes",
    "snowflake", "java", "scala", "go", "rust", "c++", "javascript", "typescript",
    "react", "node.js", "angular", "vue", "terraform", "gcp", "azure", "bigquery",
    "redshift", "dbt", "pandas", "numpy", "scikit-learn", "tensorflow", "pytorch",
    "hadoop", "hive", "presto", "tableau", "power bi", "looker", "git", "ci/cd",
    "jenkins", "github actions", "linux", "bash", "mongodb", "redis",
    "elasticsearch", "cassandra", "dynamodb", "postgresql", "mysql", "graphql",
    "rest", "grpc", "fastapi", "flask", "django", "spring", "microservices",
    "data modeling", "etl", "elt", "data warehouse", "data lake",
    "machine learning", "deep learning", "nlp", "computer vision", "mlops",
)
# -----------------------------------------------------------------------------

_WORD = r"[\p{L}\p{N}_]"


def _is_word(char: str) -> bool:
    return char == "_" or unicodedata.category(char)[0] in "LN"


def _edges_ok(text: str, start: int, end: int, boundary: str) -> bool:
    """Whether the term at text[start:end] can be a hit; beyond the ends all is possible."""
    for outer, inner in ((start - 1, start), (end, end - 1)):
        if 0 <= outer < len(text):
            wanted = False if boundary == "token" else not _is_word(text[inner])
            if _is_word(text[outer]) != wanted:
                return False
    return True


def can_overlap(first: str, second: str, boundary: str = "word") -> bool:
    """Whether some text holds whole-word hits of both terms that share a letter."""
    for shift in range(1 - len(second), len(first)):
        origin = min(0, shift)
        at_first, at_second = -origin, shift - origin
        merged = dict(enumerate(first, at_first))
        if any(merged.get(at, char) != char for at, char in enumerate(second, at_second)):
            continue
        merged.update(enumerate(second, at_second))
        text = "".join(merged[at] for at in range(len(merged)))
        if _edges_ok(text, at_first, at_first + len(first), boundary) and _edges_ok(
            text, at_second, at_second + len(second), boundary
        ):
            return True
    return False


def search_groups(terms: tuple[str, ...], boundary: str = "word") -> list[list[str]]:
    """Split terms so that within a group one scan cannot hide a hit of another term."""
    groups: list[list[str]] = []
    for term in terms:
        for group in groups:
            if not any(can_overlap(term, other, boundary) for other in group):
                group.append(term)
                break
        else:
            groups.append([term])
    return groups


def _literal(char: str) -> str:
    return char if char.isalnum() or char == " " else "\\" + char


def _tails(words: list[str]) -> str:
    """A pattern for any of the words, shared beginnings written once."""
    by_head: dict[str, list[str]] = {}
    for word in words:
        if word:
            by_head.setdefault(word[0], []).append(word[1:])
    branches = [_literal(head) + _tails(rest) for head, rest in sorted(by_head.items())]
    body = "|".join(branches)
    if "" in words and branches:
        return f"(?:{body})?"
    return f"(?:{body})" if len(branches) > 1 else body


def _edges(term: str, boundary: str) -> tuple[str, str]:
    """Look-arounds for both ends: a word edge next to a sign needs a letter outside."""
    letter_left, letter_right = (boundary == "word" and not _is_word(end) for end in (term[0], term[-1]))
    return (
        rf"(?<={_WORD})" if letter_left else rf"(?<!{_WORD})",
        rf"(?={_WORD})" if letter_right else rf"(?!{_WORD})",
    )


def group_pattern(group: list[str], boundary: str = "word") -> str:
    """One pattern for a group of terms.

    The cheapest test comes first: whether a term starts with the letter at hand,
    then the left edge, then the terms themselves, gathered by shared beginnings.
    """
    by_left: dict[str, dict[str, list[str]]] = {}
    for term in group:
        left, right = _edges(term, boundary)
        by_left.setdefault(left, {}).setdefault(right, []).append(term)
    branches = []
    for left, by_right in by_left.items():
        terms = [term for some in by_right.values() for term in some]
        heads = "".join(_literal(head) for head in sorted({term[0] for term in terms}))
        body = "|".join(f"(?:{_tails(some)}){right}" for right, some in by_right.items())
        branches.append(f"(?=[{heads}]){left}(?:{body})")
    return "|".join(branches)


def _fold(text: Column) -> Column:
    """Lower case under which the special capital and long forms of i, s match too."""
    for special, plain in (("İ", "i"), ("ı", "i"), ("ſ", "s")):
        text = F.replace(text, F.lit(special), F.lit(plain))
    return F.lower(text)


def find_terms(
    text: Column | str, dictionary: tuple[str, ...] = TECH_SKILLS, boundary: str = "word"
) -> Column:
    """Sorted distinct dictionary terms found in the text, as an array.

    `boundary="word"` asks for a word edge on both sides, so that a term ending
    in a sign (`c++`) is found only before a letter or digit. `"token"` asks
    that no letter or digit touches the term, and does find `C++` in prose.
    """
    if boundary not in ("word", "token"):
        raise ValueError(f"unknown boundary: {boundary}")
    terms = tuple(dict.fromkeys(term.lower() for term in dictionary))
    if not terms:
        return F.array().cast("array<string>")
    folded = _fold(text_or_empty(text))
    hits = [
        F.regexp_extract_all(folded, F.lit(group_pattern(group, boundary)), F.lit(0))
        for group in search_groups(terms, boundary)
    ]
    found = hits[0] if len(hits) == 1 else F.flatten(F.array(*hits))
    return F.array_sort(F.array_distinct(found))


def posting_text(description: Column | str, tags: Column | str) -> Column:
    return F.concat(text_or_empty(description), F.lit(" "), text_or_empty(tags))


def join_skills(skills: Column | str) -> Column:
    return F.array_join(as_col(skills), ", ")


def split_skills(skills: Column | str) -> Column:
    """Lower-cased names from an array or from comma-separated text; blanks dropped."""
    return F.filter(
        F.transform(F.split(text_or_empty(skills), ","), lambda s: F.lower(F.trim(s))), lambda s: s != ""
    )

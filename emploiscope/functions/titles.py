"""Classifying job titles with ordered patterns."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Categories in matching order, each with its pattern (RE2 text) on the
# lower-cased title. The first matching category wins.
CATEGORY_PATTERNS = {
    "data_engineer": r"data\s+engineer|ing[eé]nieur\s+data|d[eé]veloppeur\s+data|data\s+engineering|ing[eé]nieur\s+de\s+donn[ée]es|data\s+ing[eé]nieur|dceo\s+engineer|data\s+cent(er|re)\s+engineering\s+operations",
    "data_architect": r"architecte\s+data|data\s+architect|architecte\s+de\s+donn[ée]es",
    "data_analyst": r"data\s+analyst|analyste\s+data|business\s+data\s+analyst|data\s+product\s+analyst|analyste\s+de\s+donn[ée]es",
    "bi_decisionnel": r"(?:d[eé]veloppeur|analyste|consultant|ing[eé]nieur)\s+(?:bi|d[eé]cisionnel|business\s+intelligence)|(?:bi|d[eé]cisionnel|business\s+intelligence)\s+(?:d[eé]veloppeur|analyste|consultant|ing[eé]nieur)|power\s*bi|d[eé]veloppeur\s+bi|\bbi\b\s+(?:analyst|developer)",
    "ml_engineer": r"mlops|ml\s+engineer|machine\s+learning\s+engineer|ing[eé]nieur\s+(machine\s+learning|ml)",
    "data_scientist": r"data\s+scientist",
}
OTHER_CATEGORY = "autre_it"

CATEGORIES = (*CATEGORY_PATTERNS, OTHER_CATEGORY)

# Text that every match of a category's pattern contains: one word out of each group.
# Plain substring tests on these rule most texts out before a pattern runs.
REQUIRED_WORDS = {
    "data_engineer": [["data", "donn", "dceo"], ["engineer", "nieur", "veloppeur"]],
    "data_architect": [["data", "donn"], ["architect"]],
    "data_analyst": [["data", "donn"], ["analyst"]],
    "bi_decisionnel": [
        ["bi", "cisionnel", "intelligence"],
        ["veloppeur", "analyst", "consultant", "nieur", "power", "developer"],
    ],
    "ml_engineer": [["ml", "machine"], ["mlops", "engineer", "nieur"]],
    "data_scientist": [["data"], ["scientist"]],
}

# Letters a match of each pattern can start with; looking for them first is cheaper than
# trying every alternative at every position.
FIRST_LETTERS = {
    "data_engineer": "di",
    "data_architect": "ad",
    "data_analyst": "abd",
    "bi_decisionnel": "abcdip",
    "ml_engineer": "im",
    "data_scientist": "d",
}

# RE2 knows only ASCII word characters and leaves the vertical tab out of \s; Java differs.
_SPACE = r"[\t\n\f\r ]"
_BOUNDARY = r"(?:(?<=[0-9A-Za-z_])(?![0-9A-Za-z_])|(?<![0-9A-Za-z_])(?=[0-9A-Za-z_]))"


def re2_pattern(pattern: str) -> str:
    """The Java pattern with the meaning RE2 gives ``\\s`` and ``\\b``."""
    return pattern.replace(r"\s", _SPACE).replace(r"\b", _BOUNDARY)


def regexp_contains(text: Column, pattern: str) -> Column:
    return text.rlike(re2_pattern(pattern))


def normalised_title(title: Column) -> Column:
    return F.lower(title)


def may_match(title: Column, category: str) -> Column:
    """False only where the category's pattern cannot occur in ``title``."""
    groups = (reduce(or_, (F.contains(title, F.lit(word)) for word in words)) for words in REQUIRED_WORDS[category])
    return reduce(and_, groups)


def job_category(title: Column) -> Column:
    """First category whose pattern occurs in the lower-cased ``title``; NULL is ``autre_it``."""
    chain = F
    for category, pattern in CATEGORY_PATTERNS.items():
        quick = f"(?=[{FIRST_LETTERS[category]}])(?:{pattern})"
        chain = chain.when(may_match(title, category) & regexp_contains(title, quick), category)
    return chain.otherwise(OTHER_CATEGORY)


def is_data_job(category: Column) -> Column:
    return F.when(category != OTHER_CATEGORY, True).otherwise(False)


def is_data_engineer(category: Column) -> Column:
    return F.when(category == "data_engineer", True).otherwise(False)

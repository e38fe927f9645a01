import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from emploiscope.functions import titles

CASES = [
    ("Senior Data Engineer", "data_engineer"),
    ("Développeur Data", "data_engineer"),
    ("Ingénieur de données", "data_engineer"),
    ("Data center engineering operations", "data_engineer"),
    ("Data Engineer / Power BI", "data_engineer"),
    ("Ingénieur data scientist", "data_engineer"),
    ("Architecte data", "data_architect"),
    ("Business Data Analyst", "data_analyst"),
    ("Consultant BI", "bi_decisionnel"),
    ("PowerBI", "bi_decisionnel"),
    ("BI Developer", "bi_decisionnel"),
    ("MLOps", "ml_engineer"),
    ("Ingénieur machine learning", "ml_engineer"),
    ("Data Scientist", "data_scientist"),
    ("Ingénieure data", "autre_it"),
    ("Développeur Java", "autre_it"),
    (None, "autre_it"),
    ("", "autre_it"),
    # Only ASCII letters, digits and _ count as word characters: é ends a word.
    ("ébi developer", "bi_decisionnel"),
    ("abi developer", "autre_it"),
    # A vertical tab and a non-breaking space are no white space, a tab is.
    ("data\x0bscientist", "autre_it"),
    ("data\u00a0scientist", "autre_it"),
    ("data\tscientist", "data_scientist"),
]


# The patterns as they must be, apart from the product's own table.
PINNED = {
    "data_engineer": r"data\s+engineer|ing[eé]nieur\s+data|d[eé]veloppeur\s+data|data\s+engineering|ing[eé]nieur\s+de\s+donn[ée]es|data\s+ing[eé]nieur|dceo\s+engineer|data\s+cent(er|re)\s+engineering\s+operations",
    "data_architect": r"architecte\s+data|data\s+architect|architecte\s+de\s+donn[ée]es",
    "data_analyst": r"data\s+analyst|analyste\s+data|business\s+data\s+analyst|data\s+product\s+analyst|analyste\s+de\s+donn[ée]es",
    "bi_decisionnel": r"(?:d[eé]veloppeur|analyste|consultant|ing[eé]nieur)\s+(?:bi|d[eé]cisionnel|business\s+intelligence)|(?:bi|d[eé]cisionnel|business\s+intelligence)\s+(?:d[eé]veloppeur|analyste|consultant|ing[eé]nieur)|power\s*bi|d[eé]veloppeur\s+bi|\bbi\b\s+(?:analyst|developer)",
    "ml_engineer": r"mlops|ml\s+engineer|machine\s+learning\s+engineer|ing[eé]nieur\s+(machine\s+learning|ml)",
    "data_scientist": r"data\s+scientist",
}


def alternatives(pattern):
    """The alternatives of a pattern at its top level."""
    out, depth, start = [], 0, 0
    for i, c in enumerate(pattern):
        depth += (c == "(") - (c == ")")
        if c == "|" and not depth:
            out.append(pattern[start:i])
            start = i + 1
    return [*out, pattern[start:]]


def test_patterns_are_pinned():
    assert list(titles.CATEGORY_PATTERNS.items()) == list(PINNED.items())


@pytest.mark.parametrize(("category", "alternative"), [(c, a) for c, p in PINNED.items() for a in alternatives(p)])
def test_every_alternative_passes_the_quick_tests(category, alternative):
    @settings(max_examples=40, deadline=None, database=None)
    @given(st.from_regex(alternative.replace(r"\b", ""), fullmatch=True))
    def check(match):
        assert match[0] in titles.FIRST_LETTERS[category]
        assert all(any(word in match for word in words) for words in titles.REQUIRED_WORDS[category])

    check()


def test_categories(spark):
    df = spark.createDataFrame([(t, c) for t, c in CASES], "title string, expected string")
    lowered = df.withColumn("low", titles.normalised_title(F.col("title")))
    wrong = lowered.withColumn("got", titles.job_category(F.col("low"))).filter("got <> expected").collect()
    assert wrong == []


def test_flags_are_never_null(spark):
    df = spark.createDataFrame([("data_engineer",), ("autre_it",), ("ml_engineer",), (None,)], "c string")
    rows = df.select(titles.is_data_job(F.col("c")), titles.is_data_engineer(F.col("c"))).collect()
    assert [tuple(r) for r in rows] == [(True, True), (False, False), (True, False), (False, False)]


PIECES = st.sampled_from(
    "data donnees données engineer engineering ingénieur ingenieur développeur developpeur architecte architect analyste "
    "analyst business product intelligence bi décisionnel consultant power developer mlops ml machine learning scientist "
    "center centre operations dceo de x".split()
)


@settings(max_examples=3000, deadline=None)
@given(st.lists(st.tuples(PIECES, st.sampled_from([" ", "  ", "", "-"])), max_size=6))
def test_required_words_never_rule_out_a_match(pieces):
    text = "".join(word + gap for word, gap in pieces)
    for category, pattern in titles.CATEGORY_PATTERNS.items():
        found = re.search(pattern, text, re.ASCII)
        if found:
            assert found.group()[0] in titles.FIRST_LETTERS[category]
            groups = titles.REQUIRED_WORDS[category]
            assert all(any(word in text for word in words) for words in groups), (category, text)


@pytest.mark.parametrize("category", titles.CATEGORY_PATTERNS)
def test_every_category_has_required_words(category):
    assert titles.REQUIRED_WORDS[category]

"""T-1..T-4: the document analyser as built-in column expressions.

Tokenise on runs of characters that are neither letters, digits nor an
apostrophe (an approximation of Unicode word breaks), lower-case, trim
apostrophes at the token edges, strip an English possessive, drop stop words.
Stemming is not part of this build (no Spark primitive; see the README).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The index's English stop words (its "_english_" set).
ENGLISH_STOP_WORDS = [
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into",
    "is", "it", "no", "not", "of", "on", "or", "such", "that", "the", "their", "then",
    "there", "these", "they", "this", "to", "was", "will", "with",
]

# The index's Russian stop words (its "_russian_" set, the
# Snowball list, also shipped with Spark's StopWordsRemover).
RUSSIAN_STOP_WORDS = """
и в во не что он на я с со как а то все она так его но да ты к у же вы за бы по
только ее мне было вот от меня еще нет о из ему теперь когда даже ну вдруг ли если
уже или ни быть был него до вас нибудь опять уж вам ведь там потом себя ничего ей
может они тут где есть надо ней для мы тебя их чем была сам чтоб без будто чего раз
тоже себе под будет ж тогда кто этот того потому этого какой совсем ним здесь этом
один почти мой тем чтобы нее сейчас были куда зачем всех никогда можно при наконец
два об другой хоть после над больше тот через эти нас про всего них какая много
разве три эту моя впрочем хорошо свою этой перед иногда лучше чуть том нельзя такой
им более всегда конечно всю между
""".split()

STOP_WORDS = sorted(set(ENGLISH_STOP_WORDS) | set(RUSSIAN_STOP_WORDS))

# The token pattern (Java regex) and the edge / possessive rules.
TOKEN_SPLIT = r"[^\p{L}\p{N}']+"
EDGE_APOSTROPHES = r"^'+|'+$"
POSSESSIVE = r"'s$"


def tokens(text: Column) -> Column:
    """T-1 / T-2: lower-cased raw tokens (may contain empty strings)."""
    return F.split(F.lower(text), TOKEN_SPLIT)


def normalise_token(tok: Column) -> Column:
    """T-4: edge apostrophes trimmed, then a trailing possessive removed.
    Most tokens have no apostrophe and skip both regular expressions."""
    fixed = F.regexp_replace(F.regexp_replace(tok, EDGE_APOSTROPHES, ""), POSSESSIVE, "")
    return F.when(F.instr(tok, "'") > 0, fixed).otherwise(tok)


def is_term(tok: Column) -> Column:
    """T-3: non-empty and not a stop word."""
    return (F.length(tok) > 0) & ~tok.isin(STOP_WORDS)


def analyze(text: Column) -> Column:
    """The whole analyser as one array-valued expression (per document)."""
    return F.filter(F.transform(tokens(text), normalise_token), is_term)


def distinct_terms(text: Column) -> Column:
    """The different terms of a text. Repeated tokens go before the analyser's
    per-token work, and tokens that became the same term after it."""
    return F.array_distinct(F.filter(F.transform(F.array_distinct(tokens(text)), normalise_token), is_term))

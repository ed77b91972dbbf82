"""Secret scans with a password guess-cost model (operator 4).

Two kinds of findings, as spans in code points (end exclusive):

* **base**: fixed patterns (``assign``, ``access``, ``hex``), each kind taken
  leftmost and non-overlapping, matches that are too short dropped;
* **guess**: the value of a credential context (a word such as "password" or
  "pwd", a separator, a value) whose cheapest explanation still takes at least
  ``MIN_LOG10`` guesses.

The guess cost is a dynamic program over the value: the cheapest segmentation
into dictionary words, dates, repeats, keyboard walks and brute-force spans.
Each segment has a cost in log10 guesses and every further segment a joining
cost, so "password2019" is cheap and "xK9#pq!7Lw" is not. It runs in time
linear in the value's length, so values have no length limit.

Words are a short list of usual passwords and, if the path of a public tokenizer
is given, the words of its vocabulary, ranked as it ranks them (by frequency):
"token: authentication" then holds no secret. The vocabulary does not come from
the documents, so a secret that is copied often does not become a word.

A value that only names where the secret is kept (``${DB_PASSWORD}``,
``process.env.TOKEN``, ``get_secret(``) is none; nor is a placeholder (``<token>``,
``{{ token }}``). Calls and members count as such only when bare, not in quotes.

NULL reads as the empty text, which has no findings. Ties are ordered by start,
then kind. Rows are scanned one by one; an input column named like an output
is replaced.
"""

from __future__ import annotations

import json
import math
import re

from pyspark.sql import DataFrame
from pyspark.sql.types import (ArrayType, IntegerType, LongType, StringType, StructField,
                               StructType)

from .arrow import texts, with_columns

# The base patterns, the least lengths, and the order of kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"""([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_VALUE, ACCESS_LENGTH, HEX_LENGTH = 12, 18, 16
KINDS = ("assign", "access", "hex", "guess")

# Runs are maximal, so asking for the least length at once finds what taking
# every run and dropping the short ones would.
ACCESS = re.compile(r"AKIA[A-Z0-9]{%d,}" % (ACCESS_LENGTH - 4))
HEX = re.compile(r"[0-9a-f]{%d,}" % HEX_LENGTH)

#: Credential contexts: a word, a separator, then a quoted or bare value. The word
#: may follow any prefix that ends in no letter (DB_PASSWORD) or before a capital
#: (userPassword, APIToken); forms of "password" may follow letters (PGPASSWORD).
CONTEXT_WORDS = ("pass", "pwd", "secret", "token", "key", "credential", "auth")
CONTEXT = re.compile(
    r"""(?:pass(?:word|wd|phrase)"""
    r"""|(?:(?<![a-z])|(?-i:(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])))"""
    r"""(?:pass(?:code)?|pwd|secret|(?:access|auth|bearer)?[_ -]?token"""
    r"""|(?:api|(?:secret[_ -]?)?access|private|secret|auth|encryption|signing|account)[_ -]?key"""
    r"""|credentials?))["']?[ \t]*(?::=|=>|[:=])[ \t]*"""
    r"""(?:"(?P<double>[^"\r\n]+)"|'(?P<single>[^'\r\n]+)'|(?P<bare>[^\s"'<>,;]+))""",
    re.IGNORECASE | re.ASCII)

MIN_LOG10 = 8.5     # fewer guesses: a guessable or placeholder value; eight brute-forced characters cost 8.7
JOIN_LOG10 = 0.5    # cost of each further segment
BRUTE_LOG10 = 1.0   # a brute-forced character: ten guesses, as is usual
BRUTE_START = 0.7

# Common words in order of frequency in public lists of leaked passwords and
# placeholders; a word's rank is its cost.
WORDS = """password welcome letmein admin login secret master dragon monkey qwerty
sunshine princess football baseball shadow superman michael jordan hunter
soccer summer winter spring autumn monday friday love hello freedom whatever
trust access token changeme change example sample test testing demo user root
guest default required none null undefined your here value string placeholder
key pass pwd code word my the this is not and for with new old company home
""".split()
RANK = {w: i + 1 for i, w in enumerate(WORDS)}

SEPARATORS = "-_. /"       # one between words joins them at no further cost
SEPARATOR_LOG10 = math.log10(len(SEPARATORS))
LEAST_WORD = 4             # letters of a vocabulary's words; shorter ones are as cheap by brute force

#: Values that stand for a secret kept elsewhere: in quotes or bare, and only bare.
TEMPLATE = re.compile(r"\$\{[^{}]*\}?|\$\([^()]*\)?|\$(?:[A-Z_][A-Z0-9_]*|[a-z_]+)|\{\{.*|<[^<>]*>|"
                      r"%\([A-Za-z_]+\)s|%[A-Z_]+%|\{[A-Za-z_]+\}")
REFERENCE = re.compile(r"(?:process\.env|import\.meta\.env|os\.environ|System\.getenv|ENV|env|config|settings|secrets|"
                       r"self|this|request|params|args|options|props|vars?|local|data)[.\[(][\w.\[\]()]*"
                       r"|[A-Za-z_]{4,}(?:\.[A-Za-z_]+)*(?:\[(?:[A-Za-z_]\w*\])?|\([A-Za-z_.]*)[.)\]]*", re.ASCII)


class Words:
    """Words with their ranks, and the lengths that words have."""

    def __init__(self, ranks: dict[str, int]):
        self.ranks, self.lengths = ranks, sorted({len(w) for w in ranks})


FIXED = Words(RANK)
_READ: dict[str, Words] = {}  # in a worker


def dictionary(path: str | None) -> Words:
    """The fixed words, then the whole words of a tokenizer's vocabulary in the
    order of their ids (at most one per token)."""
    if path is None:
        return FIXED
    if path not in _READ:
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        ranks = dict(RANK)
        for token in sorted(vocabulary, key=vocabulary.get):
            # a token that begins or ends a word says so by a mark
            word = token[1:] if token[:1] in "Ġ▁" else token[:-4] if token.endswith("</w>") else ""
            word = word.lower()
            if len(word) >= LEAST_WORD and word.isascii() and word.isalpha():
                ranks.setdefault(word, len(ranks) + 1)
        _READ.clear()
        _READ[path] = Words(ranks)
    return _READ[path]

ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
UNSHIFT = dict(zip('~!@#$%^&*()_+{}|:"<>?', "`1234567890-=[]\\;',./", strict=True))
LEET = str.maketrans("4@3105$7", "aaeiosst")

DATE = re.compile(
    r"(?:19|20)\d\d(?:[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01]))?"
    r"|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)?\d\d")


def _neighbours() -> set[tuple[str, str]]:
    """Pairs of keys that touch: in a row, or half a key apart in rows above."""
    place = {c: (x + 0.5 * y, y) for y, row in enumerate(ROWS) for x, c in enumerate(row)}
    return {(a, b) for a, (x, y) in place.items() for b, (u, v) in place.items()
            if a != b and abs(y - v) <= 1 and abs(x - u) <= (1 if y == v else 0.5)}


ADJACENT = _neighbours()


def _walks(value: str) -> list[int]:
    """For each position, the start of the keyboard walk or sequence through it."""
    keys = [UNSHIFT.get(c, c) for c in value.lower()]
    start, step, kind = [0] * len(keys), 0, ""
    for i in range(1, len(keys)):
        jump = ord(keys[i]) - ord(keys[i - 1])
        now = ("step" if abs(jump) == 1 and keys[i].isalnum() and keys[i - 1].isalnum()
               else "walk" if (keys[i - 1], keys[i]) in ADJACENT else "")
        same = now and (now == kind and (now == "walk" or jump == step) or start[i - 1] == i - 1)
        start[i] = start[i - 1] if same else i - 1 if now else i
        kind, step = now, jump
    return start


def _repeats(value: str) -> dict[int, list[tuple[int, float]]]:
    """Runs of a block of 1 to 4 characters: end -> [(start, cost)]. Only a
    run's every whole number of rounds from its beginning counts."""
    found: dict[int, list[tuple[int, float]]] = {}
    n = len(value)
    for size in (1, 2, 3, 4):
        begin = 0
        for i in range(size, n + 1):
            if i < n and value[i] == value[i - size]:
                continue
            rounds = (i - begin) // size
            if rounds >= 3 or (rounds == 2 and size > 1):
                for r in range(2 if size > 1 else 3, rounds + 1):
                    found.setdefault(begin + r * size, []).append(
                        (begin, size * BRUTE_LOG10 + math.log10(r)))
            begin = i - size + 1
    return found


def _case_cost(piece: str) -> float:
    """Guesses for the use of capitals: none, first or all are cheap."""
    if piece.islower() or not any(c.isupper() for c in piece):
        return 0.0
    if piece[1:].islower() or piece.isupper() or len(piece) == 1:
        return math.log10(2)
    upper = sum(c.isupper() for c in piece)
    return math.log10(math.comb(len(piece), min(upper, len(piece) - upper)) + 1)


def guess_cost(value: str, words: Words = FIXED) -> float:
    """log10 of the guesses for ``value`` (0 for the empty one)."""
    n = len(value)
    if not n:
        return 0.0
    lower = value.lower()
    if len(lower) != n:  # a letter whose lower case is longer: compare as it is
        lower = value
    plain = lower.translate(LEET)
    walk, repeats = _walks(value), _repeats(value)
    dates: dict[int, list[tuple[int, float]]] = {}
    for i in range(n):
        if value[i].isdigit() and (m := DATE.match(value, i)):
            dates.setdefault(m.end(), []).append((i, math.log10(120 if m.end() - i == 4 else 365 * 120)))
    closed = [0.0] + [math.inf] * n  # cheapest with a segment ending here
    brute = [math.inf] * (n + 1)     # cheapest with a brute-force span open here

    for end in range(1, n + 1):
        options = []
        for length in words.lengths:
            if length > end:
                break
            i = end - length
            for form, extra in ((lower, 0.0), (plain, 0.5)):
                if (rank := words.ranks.get(form[i:end])) is not None:
                    options.append((i, math.log10(rank + 1) + _case_cost(value[i:end]) + extra))
                    break
        options += dates.get(end, ())
        options += repeats.get(end, ())
        i = walk[end - 1]
        if end - i >= 3:
            options.append((i, math.log10(47 * 4 * (end - i))))
        best = min((closed[i] + (JOIN_LOG10 if i and value[i - 1] not in SEPARATORS else 0.0) + cost
                    for i, cost in options), default=math.inf)
        if end > 1 and value[end - 1] in SEPARATORS:
            best = min(best, closed[end - 1] + SEPARATOR_LOG10)
        brute[end] = min(brute[end - 1] + BRUTE_LOG10,
                         closed[end - 1] + (JOIN_LOG10 if end > 1 else 0.0) + BRUTE_START + BRUTE_LOG10)
        closed[end] = min(best, brute[end])
    return closed[n]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base findings."""
    found = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text)
                  if m.end(2) - m.start(2) >= ASSIGN_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def refers(value: str, bare: bool) -> bool:
    """Whether the value stands for a secret that is kept elsewhere."""
    return TEMPLATE.fullmatch(value) is not None or bare and REFERENCE.fullmatch(value) is not None


def guess_spans(text: str, min_log10: float = MIN_LOG10, words: Words = FIXED) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the costly values in credential contexts."""
    low = text.lower()
    if not any(w in low for w in CONTEXT_WORDS):
        return []
    found = []
    for m in CONTEXT.finditer(text):
        a, b = m.span(m.lastgroup)
        if not refers(text[a:b], m.lastgroup == "bare") and guess_cost(text[a:b], words) >= min_log10:
            found.append((a, 3, b))
    return found


SPAN = StructType([StructField("kind", StringType()), StructField("start", IntegerType()),
                   StructField("end", IntegerType())])


def find_secrets(docs: DataFrame, text: str = "text", spans: str = "secret_spans",
                 min_log10: float = MIN_LOG10, drop: tuple[str, ...] = (),
                 vocabulary: str | None = None) -> DataFrame:
    """``docs`` with the array ``spans`` of findings (kind, start, end).
    ``vocabulary`` is the path of a tokenizer file with words."""

    def factory():
        words = dictionary(vocabulary)

        def work(batch):
            return [[[{"kind": KINDS[k], "start": a, "end": b}
                      for a, k, b in sorted(base_spans(t) + guess_spans(t, min_log10, words))]
                     for t in texts(batch, text)]]

        return work

    return with_columns(docs, factory, [StructField(spans, ArrayType(SPAN))], drop=drop)


def redact(docs: DataFrame, text: str = "text", min_log10: float = MIN_LOG10,
           vocabulary: str | None = None) -> DataFrame:
    """``docs`` with every finding in ``text`` replaced by ``<secret>``;
    overlapping findings are replaced together, NULL stays NULL. A column
    ``n_chars`` is recounted."""
    have = {c.lower(): c for c in docs.columns}

    def factory():
        words = dictionary(vocabulary)

        def clean(t: str) -> str:
            out, at = [], 0
            for a, _, b in sorted(base_spans(t) + guess_spans(t, min_log10, words)):
                if b > at:
                    if a >= at:
                        out += [t[at:a], "<secret>"]
                    at = b
            return "".join(out) + t[at:] if out else t

        def work(batch):
            made = [None if t is None else clean(t) for t in batch.column(text).to_pylist()]
            return [made] + [[None if t is None else len(t) for t in made]] * ("n_chars" in have)

        return work

    fields = [StructField(text, StringType())]
    if "n_chars" in have:
        fields.append(StructField(have["n_chars"], LongType()))
    return with_columns(docs, factory, fields).select(*docs.columns)

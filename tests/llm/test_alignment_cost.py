"""Operator 13: the cost of a chunk, not only its result."""

import gc

import sentencepiece

from reelsync.llm import alignment as A

from .test_alignment import PATHS, same


def test_spans_come_without_messages_and_the_collector_rests(monkeypatch):
    """No message object per chunk is parsed, and no collection of cycles runs
    inside a batch; both were a third of the time."""
    def parsed(*_):
        raise AssertionError("a message was parsed")

    monkeypatch.setattr(sentencepiece, "_to_spt", parsed)
    aligner, seen = A.Aligner(*PATHS), []
    chunks = aligner.chunks
    monkeypatch.setattr(aligner, "chunks", lambda *a: (seen.append(gc.isenabled()), chunks(*a))[1])
    same(aligner, "plain words, café 𝒳 \U0001F600\n\nnext​line", "a\n b", "\nfirst", "", "plain words again")
    assert seen and not any(seen) and gc.isenabled()


def test_a_chunk_moves_between_generations(monkeypatch):
    monkeypatch.setattr(A, "CACHE", 3)
    aligner = A.Aligner(*PATHS)
    same(aligner, "one two three four five")  # more than a generation: it ages
    assert not aligner.young and len(aligner.old) == 5
    same(aligner, "five six")
    assert set(aligner.young) == {"five", "six"}

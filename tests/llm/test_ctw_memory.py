"""A part's byte grams are made in place: memory per byte of text is bounded."""

import tracemalloc

import numpy as np

from noticelake.llm import ctw
from noticelake.llm.text import Words


def peak(size: int) -> float:
    data = np.frombuffer((b"some words of a text " * (size // 21 + 1))[:size], np.uint8)
    words = Words(data, np.array([0, size // 2, size]), lower=True)
    words.spaced()
    tracemalloc.start()
    ctw.byte_grams(words)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return most / size


def test_byte_grams_take_little_memory():
    assert peak(1 << 20) < 36  # 44 before


def test_scoring_takes_smaller_parts_than_counting():
    assert ctw.SCORED < ctw.PART

"""Rows, word rules and fixtures that the tests share."""

import re

import pyarrow.parquet as pq
import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SHAPE = "doc_id long, text string, lang string, source string, slot int, copies string, key string"

PASSAGE = " ".join(f"p{i}" for i in range(60))
BASE = " ".join(f"base{i % 97}x{i}" for i in range(120))


def words(text, lower=False):
    text = text or ""
    return WORD.findall(text.translate(LOWER) if lower else text)


def hard_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns whose
    names the operators use themselves."""
    texts = {
        1: BASE,
        2: BASE.upper(),
        3: BASE,
        4: BASE.replace("base7x7 ", "other "),
        5: "start " + PASSAGE + " end",
        6: "one two three " + PASSAGE,
        7: PASSAGE + " " + PASSAGE,
        8: None,
        9: "",
        10: " \t\n ",
        11: "short text",
        12: "SHORT text",
        13: "été ÄÖ straße 你好 🙂 it's  we'll 'tis\n\n x",
        14: "word " * 30_000,
        15: "a" * 50_000,
        16: "x" + "\x0b".join(f"v{i}" for i in range(40)),
        17: "!!! ### $$$ 123",
    }
    rows = [(i, t, "en" if i % 2 else "fr", f"s{i % 3}", 1, "c", "k") for i, t in texts.items()]
    rows += [rows[0], rows[4], (None, BASE, None, None, None, None, None), (None, None, "en", "s1", 1, "c", "k")]
    rows.append((20, None, None, None, None, None, None))
    return rows


@pytest.fixture(scope="module")
def hard(spark):
    return spark.createDataFrame(hard_rows(), SHAPE)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SHAPE)


@pytest.fixture(scope="session")
def small():
    """The texts of the smallest data set, as rows of a dict."""
    return pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pylist()


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"

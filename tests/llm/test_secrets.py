"""Assignments in more syntaxes, and names that stop meaning what they did."""

import random
import time

import pytest

from alertloom.llm import piece_coding, secret_scan

VALUE = "Zq9-xx77LmN4pQvB"


@pytest.mark.parametrize(
    "text",
    [
        f'private_key\t=\t"{VALUE}"',
        f'config["private_key"] = "{VALUE}"',
        f"config['private_key']= '{VALUE}'",
        f'private_key = f"{VALUE}"',
        f"private_key = `{VALUE}`",
        f'"{"a_" * 45}private_key": "{VALUE}"',
        f'x = "{VALUE}"\nprivate_key = x',
        f'x = y\nx = "{VALUE}"\nprivate_key = x',
    ],
)
def test_values_of_sensitive_names_are_found(text):
    spans = secret_scan.literal_spans(text)
    assert len(spans) == 1 and (VALUE in text[spans[0][0] : spans[0][1]] or text[spans[0][0] :] == "x")


@pytest.mark.parametrize(
    "text",
    [
        f'x = "{VALUE}"\nx = f + g\nprivate_key = x',  # unknown now
        f'config[private_key"] = "{VALUE}"',
        f'a == "{VALUE}"',
        f'private_key == "{VALUE}"',
        f'private_key :: "{VALUE}"',
        f'private_key = other\n"{VALUE}"',
    ],
)
def test_values_that_no_sensitive_name_gets_are_left(text):
    assert secret_scan.literal_spans(text) == []


def test_long_runs_take_time_in_proportion():
    began = time.time()
    for run in ("a", "a.", " ", "\t", "=", ":", '"', "`", "a=", "] ", "1a"):
        secret_scan.all_spans(run * (300_000 // len(run)) + "=")
    assert time.time() - began < 60


def test_decoded_text_is_that_of_the_ids():
    sentencepiece = pytest.importorskip("sentencepiece")
    public = pytest.importorskip("public_tokenizers")
    path = public.path(piece_coding.MODEL)
    library, own = sentencepiece.SentencePieceProcessor(model_file=path), piece_coding.PieceCoder(path)
    chance = random.Random(2)
    parts = [" ", "  ", "   ", "\n", "\t", "▁", "the", "Word", "é", "漢字", "\U0001f600", "\u0000", "​", "...", "x" * 40]
    for _ in range(400):
        text = "".join(chance.choice(parts) for _ in range(chance.randint(0, 14)))
        coded, plain = own.coded(text)
        ids = library.encode(text)
        assert coded == ",".join(map(str, ids)) and plain == library.decode(ids), repr(text)

"""Sentence units: rules on invented texts, and chunks against whole texts."""

import random

import numpy as np
import pytest
from foliant.llm import sentences as s


def cut(text):
    return [text[a:b] for a, b in s.units(text)]


@pytest.mark.parametrize(
    "parts",
    [
        ["Dr. Moss saw 3.5 cm of fog.", "It left at 9 p.m.", "We slept."],
        ["She said: \"Stop! Look at me!\" and ran.", "\"No way. Go,\" he said."],
        ["« Vous partez ? Non ! » dit M. Roy.", "Il faut env. 3 min. pour lire, c.-à-d. peu."],
        ["Am 5. Januar lag das Buch im 2. Regal, z. B. offen.", "Nein."],
        ["El 5 de en. de 1994 llovía.", "¿Por qué?", "¡Qué sí!"],
        ["Ο κ. Βάρης ήρθε στις 9 π.μ. και έφυγε.", "Γιατί;", "Δεν ξέρω."],
        ["No.", "See no. 4 of the list.", "No."],
    ],
)
def test_spaced_scripts(parts):
    assert cut(" ".join(parts)) == parts


@pytest.mark.parametrize("parts", [["我不知道。", "“走吧。快走。”她说。", "为什么？！"], ["彼は「はい。そうです。」と言った。", "終わり！"], ["वह गया।", "डॉ. राम ने 3.5 मि.मी. देखा।"]])
def test_unspaced_scripts(parts):
    assert cut("".join(parts)) == parts


def test_thai_blanks():
    assert cut("หน้าปกกว้าง 7.2 มิลลิเมตร ทำไมหน้าปกหายไป เขามาเวลา 7:05 น. เพื่อตรวจ") == ["หน้าปกกว้าง 7.2 มิลลิเมตร", "ทำไมหน้าปกหายไป", "เขามาเวลา 7:05 น. เพื่อตรวจ"]


def test_lines():
    text = "Notes on paper\n\nThe first line of this text is long enough to be wrapped by an\neditor here.\n- red box\n12) blue box\nLast words"
    assert cut(text) == ["Notes on paper", "The first line of this text is long enough to be wrapped by an\neditor here.", "- red box", "12) blue box", "Last words"]


@pytest.mark.parametrize("text", ["", "  \n\t ", "...", "***\n---"])
def test_nothing(text):
    assert cut(text) == []


def test_functions_compose():
    rng = random.Random(1)
    tokens = [(rng.randrange(len(s.SYMBOLS)), k, k + 1) for k in range(400)]
    parts = [tokens[k : k + 37] for k in range(0, 400, 37)]
    states = s.scan(np.array([s.function(p) for p in parts]))
    state = s.START
    for p, before in zip(parts, states, strict=True):
        assert state == before
        state = s.read("x" * 500, p, state)[0]


def test_long_texts_in_chunks(spark):
    rng = random.Random(2)
    pieces = ["It was no. 4.", "\"Why? Go!\" she said.", "Dr. Moss came at 9 a.m. and left.", "没有。", "- red box\n", "\n\nHead\n\n", "what a long line it is, and it goes on and on", "He said: \"A. B! C\" and slept."]
    texts = [" ".join(rng.choice(pieces) for _ in range(n)) for n in (1, 40, 900, 2500)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(10, None), (11, ""), (12, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, s.sentence_units(df, row_chars=3000).collect()))
    assert got == [(k, a, b) for k, t in enumerate(texts) for a, b in s.units(t)]


@pytest.mark.parametrize("chunk", [1, 7, 90, 2048])
def test_chunks_of_any_size(chunk):
    rng = random.Random(3)
    pieces = ["It was no. 4. ", "\"Why? Go!\" she said. ", "« Non. Oui ! » dit-il. ", "„Ja. Nein.“ Er ging. ", "»So. Gut.« Ende. ", "没有。", "- red box\n", "\n\nHead\n\n", "“A. B ", "1. one thing\n"]
    for _ in range(60):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 40)))
        assert s.units(text, chunk) == s.units(text, 10**9)


def test_quotations_of_any_length():
    """A quotation holds together however long it is; a mark without a partner in its paragraph holds nothing."""
    inner = "Stop there. Look at me! " * 300
    text = f'She said: "{inner}Go on." and ran.'
    assert len(text) > 5000 and cut(text) == [text]
    assert len(cut(f'She said: "{inner}Go on.\n\nAnd a " mark.')) > 600
    assert cut("Er rief: „Komm. Geh.“ und ging. »Ja. Nein.« sagte sie.") == ["Er rief: „Komm. Geh.“ und ging.", "»Ja. Nein.« sagte sie."]


def test_repeated_and_long_texts(spark):
    """Repeated rows give theirs each, short or long; quotations cross the rows that a long text is cut into."""
    quoted = 'He said: "' + "Go now. " * 1500 + 'Run." and slept. '
    texts = [(1, "One. Two."), (1, "One. Two."), (2, quoted * 2), (2, quoted * 2), (None, quoted), (0, quoted)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = sorted(map(tuple, s.sentence_units(df, row_chars=5000).collect()), key=repr)
    assert got == sorted(((d, a, b) for d, t in texts for a, b in s.units(t)), key=repr)
    assert sum(r[0] == 2 for r in got) == 4
    assert s.sentence_units(df.limit(0)).collect() == []

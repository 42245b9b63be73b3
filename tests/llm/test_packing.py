import collections
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from caseframe.llm.packing import best_two_fit, cut, pack
from caseframe.llm.queries import TOKENIZER
from caseframe.llm.tokens import Encoder
from tests.llm.helpers import documents, generator, sentence, small, texts

ODD = [
    "", " ", "  ", "a  b", " a b ", "a\nb", "a \nb", "a\n b", "a\n\nb", "it's\tI'll 12x", "!\x1c? \x1f",
    "<|endoftext|> x<|endoftext|>", "é b  c", "x" * 300, "a\r\nb", "日本 語", "🙂 🙂", "²½ x",
]


def test_units_give_the_tokenizers_ids():
    rng = generator(0)
    values = ODD + ["".join(rng.choice("aé1' \n\t! \x1c") for _ in range(40)) for _ in range(500)]
    whole = Tokenizer.from_file(TOKENIZER)
    encoder = Encoder(TOKENIZER)
    for _ in range(2):
        for text, packed in zip(values, encoder.encode(values), strict=True):
            expected = whole.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(packed, "<u4").tolist() == expected, repr(text)


def check_packing(rows, plain, sequence):
    whole = Tokenizer.from_file(TOKENIZER)
    pieces, places = collections.defaultdict(list), collections.defaultdict(list)
    for row in rows:
        pieces[row["doc_id"]].append(row)
        places[row["sequence_id"]].append((row["offset"], row["length"]))
    expected = collections.Counter()
    for doc_id, text in plain:
        ids = [*whole.encode(text, add_special_tokens=False).ids, 0]
        for piece, (start, length) in enumerate(cut(len(ids), sequence)):
            crc = zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())
            expected[doc_id, piece, start, length, crc] += 1
    found = collections.Counter(
        (row["doc_id"], row["piece"], row["start"], row["length"], row["ids_crc32"]) for row in rows
    )
    assert found == expected
    for filled in places.values():
        at = 0
        for offset, length in sorted(filled):
            assert offset == at
            at += length
        assert at <= sequence
    return len(places)


@pytest.mark.parametrize("sequence", [16, 2048])
def test_packing_of_the_tables(spark, sequence):
    df = small(spark, "documents").limit(60)
    plain = texts(df)
    rows = pack(df, TOKENIZER, sequence).collect()
    used = check_packing(rows, plain, sequence)
    least = -(-sum(row["length"] for row in rows) // sequence)
    assert least <= used <= least * 1.05 + 2


def test_packing_edges(spark):
    rows = [(1, None), (2, ""), (None, "a b"), (3, "a b"), (3, "a b"), (4, sentence(generator(1), 900))]
    rows += list(enumerate(ODD, 10))
    df = documents(spark, rows, extra=True)
    found = pack(df, TOKENIZER, 32, with_ids=True).collect()
    check_packing(found, [(doc_id, text or "") for doc_id, text in rows], 32)
    assert all(zlib.crc32(np.array(row["ids"], "<u4").tobytes()) == row["ids_crc32"] for row in found)
    assert pack(documents(spark, []), TOKENIZER).count() == 0


def test_cut_leaves_the_short_piece_first():
    assert cut(5, 4) == [(0, 1), (1, 4)]
    assert cut(8, 4) == [(0, 4), (4, 4)]
    assert cut(1, 4) == [(0, 1)]


def test_plan_uses_every_piece_once_and_is_tight():
    rng = np.random.default_rng(0)
    for _ in range(30):
        counts = np.zeros(101, np.int64)
        for length in rng.integers(1, 101, rng.integers(1, 300)):
            counts[length] += rng.integers(1, 50)
        plan = best_two_fit(counts, 100)
        left = counts.copy()
        bins = 0
        for pattern, times in plan:
            assert times > 0 and sum(length * uses for length, uses in pattern) <= 100
            bins += times
            for length, uses in pattern:
                left[length] -= uses * times
        assert not left.any()
        # First-fit decreasing is within 11/9 of the best; this is no worse.
        big = counts[51:].sum()
        assert bins <= max(big, (counts * np.arange(101)).sum() / 100) * 11 / 9 + 1


def test_two_documents_replace_the_smallest():
    counts = np.zeros(11, np.int64)
    counts[[6, 3, 2]] = [1, 1, 2]
    # Greedy: 6 + 3 with a gap of 1; 3 gives way to 2 + 2, which fill it.
    assert best_two_fit(counts, 10)[0] == ([(6, 1), (2, 2)], 1)


def test_latin_texts_by_the_second_implementation_have_the_tokenizers_ids():
    rng = generator(5)
    whole, encoder = Tokenizer.from_file(TOKENIZER), Encoder(TOKENIZER)
    assert encoder.second is not None
    signs = [chr(code) for code in range(0x250)]
    values = [a + b for a in signs[::3] for b in signs[::7]]
    values += ["".join(rng.choice(signs) for _ in range(rng.randrange(1, 60))) for _ in range(3000)]
    values += ["".join(rng.choice("aB1' .\n\t!é ß²\x85\xa0") for _ in range(80)) for _ in range(2000)]
    values += ["the " * 5000, "a" * 499, "a" * 501, " " * 499 + "x", " " * 501 + "x", "\n \n" * 400, "Ab" * 3000]
    values += [f"{word}'{end} 12{word}" for word in ("it", "É", "x9") for end in ("s", "t", "re", "S", "ll")]
    taken = 0
    for text, packed in zip(values, encoder.encode(values), strict=True):
        expected = whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(packed, "<u4").tolist() == expected, repr(text)
        taken += encoder._is_plain(text) and encoder._is_latin(text)
    assert taken > 0.5 * len(values)


def test_the_second_implementation_needs_a_file_that_asks_for_it(tmp_path):
    import json

    with open(TOKENIZER, encoding="utf-8") as file:
        told = json.load(file)
    told["pre_tokenizer"]["add_prefix_space"] = True
    path = tmp_path / "other.json"
    path.write_text(json.dumps(told), encoding="utf-8")
    assert Encoder(str(path)).second is None

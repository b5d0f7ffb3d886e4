import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerloom.llm.queries import op8_token_files, vocabulary
from ledgerloom.llm.storage import fresh_path
from ledgerloom.llm.token_files import Encoder, PartReader, token_round_trip, write_tokens

from .tables import frame, odd_rows

PATH = vocabulary("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def plain(library, rows):
    """Sorted by id, nulls first: (doc_id, start, n_tokens, crc)."""
    start, out = 0, []
    for i, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_given_documents(spark, library):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in op8_token_files(spark, folder).collect()) == sorted(plain(library, rows))


def test_odd_rows(spark, library):
    """Rows that repeat an id may come in either order; ids and starts are the same either way."""
    rows = [*odd_rows(4), (None, "no id", None, None), (999, "x <|endoftext|> y # " * 3, "en", "a")]
    got = sorted((tuple(r) for r in token_round_trip(frame(spark, rows).repartition(5), PATH, 2).collect()), key=str)
    want = plain(library, rows)
    once = [r for r in want if [x[0] for x in want].count(r[0]) == 1]
    assert [r for r in got if r[0] in {x[0] for x in once}] == sorted(once, key=str)
    assert sorted((r[0] or -1, r[2], r[3]) for r in got) == sorted((r[0] or -1, r[2], r[3]) for r in want)
    ends = sorted((r[1], r[1] + r[2]) for r in got)
    assert all(a[1] == b[0] for a, b in zip(ends, ends[1:]))


def test_empty_table(spark):
    assert token_round_trip(frame(spark, []), PATH, 2).count() == 0


def test_sequences_by_number(spark, library):
    """Random access gives the same ids as the whole stream; masks mark the padding."""
    rows = odd_rows(6)
    folder = fresh_path(spark, "test-tokens")
    with open(PATH, encoding="utf-8") as file:
        definition = file.read()
    parts = write_tokens(frame(spark, rows).repartition(3), folder, definition, 2, length=16, rows=4).collect()
    stream = []
    for part in sorted(parts, key=lambda p: p.part):
        reader = PartReader(folder, part.part)
        n = -(-part.n_tokens // 16)
        places = list(range(n))
        random.Random(1).shuffle(places)
        found = {k: tuple(x.copy() for x in reader.sequence(k)) for k in places}
        ids = np.concatenate([found[k][0] for k in range(n)])
        mask = np.concatenate([found[k][1] for k in range(n)])
        assert mask.sum() == part.n_tokens and mask[: part.n_tokens].all() and len(ids) == 16 * n
        assert (reader.ids(0, part.n_tokens) == ids[: part.n_tokens]).all()
        stream += ids[: part.n_tokens].tolist()
    want = sum(len(library.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in rows)
    assert len(stream) == want == sum(p.n_tokens for p in parts)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_is_the_library(name):
    path = public_tokenizers.path(name)
    with open(path, encoding="utf-8") as file:
        own = Encoder(file.read(), "<u2")
    library, rng = Tokenizer.from_file(path), random.Random(2)
    letters = "ab é\n \t'ß  1.,s\u3000<|endoftext|>\r\x1c\x85\xa0中٣'ll're #"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(3000)]
    texts += ["", " ", "  ", "\n", "a  ", "it's <|endoftext|> we'll", "'s", "x" * 5000]
    for text, ids in zip(texts, own.encode(texts)):
        assert np.frombuffer(ids, "<u2").tolist() == library.encode(text, add_special_tokens=False).ids, text

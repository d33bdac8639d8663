"""Token counts against a plain merge by rank."""

import base64
from pathlib import Path

import pytest
import regex

from docloom import cli, schemas
from docloom import fixed_values as V
from docloom.functions import tokens
from docloom.functions.tokens import PIECES, rank_counter
from docloom.plans import catalogue, text_queries

FOLDER = "/root/testdata/sf0.001"
needs_ranks = pytest.mark.skipif(
    not (Path(text_queries.RANKS).exists() and Path(FOLDER).exists()), reason="vocabulary or tables are not here"
)


def merged(ranks, piece):
    """The best ranked pair of neighbours merges first, the leftmost of equals."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
        if rank == 1 << 60:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


def plain_count(ranks, text):
    pieces = (p.encode() for p in regex.findall(PIECES, text))
    return sum(1 if p in ranks else len(merged(ranks, p)) for p in pieces)


def table(lines):
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


@pytest.fixture
def small(tmp_path):
    """All bytes and a few merges of them."""
    words = [bytes([b]) for b in range(256)] + [b"th", b"the", b" the", b"in", b"ing", b"he", b"er", b"\xc3\xa9", b"aa", b"aaaa"]
    lines = [f"{base64.b64encode(w).decode()} {i}" for i, w in enumerate(words)]
    path = tmp_path / "small.tiktoken"
    path.write_text("\n".join(lines) + "\n")
    return str(path), table(lines)


def test_counts_are_those_of_plain_merges(spark, apply, small):
    path, ranks = small
    texts = [
        "the thing in there", "", None, " ", "the" * 40, "a" * 333, "caf\u00e9 \u6cb3\u6c34 \U0001f600!", "<|endoftext|>",
        "  tabs\t\n and  spaces  ", "it's 12345 they'll", "x" + "\u00e9" * 50,
    ]
    want = [None if t is None else plain_count(ranks, t) for t in texts]
    assert apply(rank_counter(spark, path), texts) == want
    assert want[1] == 0 and want[4] < 120


def test_rank_files_are_checked(spark, small, tmp_path, monkeypatch):
    path, _ = small
    assert tokens.read_ranks(spark, "file:" + path) == tokens.read_ranks(spark, path)
    (tmp_path / "bad").write_text("no rank file here\n")
    with pytest.raises(ValueError, match="no rank file"):
        rank_counter(spark, str(tmp_path / "bad"))
    monkeypatch.setattr(tokens, "MOST_RANKS", 100)
    for p in (path, "file:" + path):
        with pytest.raises(ValueError, match="more than 100"):
            rank_counter(spark, p)


def test_command_line_counts_by_the_given_ranks(spark, small, tmp_path):
    path, ranks = small
    fields = dict.fromkeys(schemas.DOCUMENTS.names) | {"doc_id": "d", "texto": "The thing is there. It ings.", "estado": "ok"}
    spark.createDataFrame([tuple(fields.values())], schemas.DOCUMENTS).write.parquet(f"{tmp_path}/docs")
    cli.main(["chunk", "--input", f"{tmp_path}/docs", "--output", f"{tmp_path}/out", "--lotes", "1", "--tokens", path])
    made = spark.read.parquet(f"{tmp_path}/out/chunks").collect()
    assert [(r.num_tokens, r.n_palabras_chunk) for r in made] == [(plain_count(ranks, fields["texto"]), 6)]


@needs_ranks
def test_chunk_tokens(spark):
    ranks = table(Path(text_queries.RANKS).read_text().split("\n"))
    got = {r.chunk_id: r for r in catalogue.QUERIES["chunk_tokens"](spark, FOLDER).collect()}
    texts = catalogue.QUERIES["chunks"](spark, FOLDER).select("chunk_id", "texto", "num_tokens").collect()
    assert set(got) == {r.chunk_id for r in texts}
    for r in texts:
        made = got[r.chunk_id]
        assert made.num_tokens == plain_count(ranks, r.texto) and made.n_palabras_chunk == r.num_tokens
        assert made.bucket == ("short" if made.num_tokens <= V.SHORT_TOKENS else "long")

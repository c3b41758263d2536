"""The registered queries with an oracle, against DuckDB on the smallest tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest

from popdist.llm.oracles import ORACLES
from popdist.llm.queries import REGISTRY
from tests_llm_helpers import check_pieces, linked_classes


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    from inputs import SMALL

    got = REGISTRY[name](spark, SMALL)
    want = duck.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(repr, map(tuple, got.select(columns).collect()))) == sorted(map(repr, want.fetchall()))


def test_every_operator_is_registered():
    assert {n.split("_")[0] for n in REGISTRY} == {"pipeline", *(f"op{i}" for i in range(1, 14))}


# -- registered queries without an oracle, on whole tables, against plain Python --------

@pytest.fixture(scope="module")
def texts(spark):
    from inputs import SMALL

    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


def rows_of(spark, name):
    from inputs import SMALL

    return REGISTRY[name](spark, SMALL).collect()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_op2_base_spans(spark, texts):
    kinds = {"assign": (re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 8),
             "access": (re.compile("AKIA[A-Z0-9]+"), 0, 16), "hex": (re.compile("[0-9a-f]+"), 0, 32)}
    for r in rows_of(spark, "op2_secret_scan"):
        found = [(m.start(), n, kind, m.end()) for n, (kind, (pattern, group, least)) in enumerate(kinds.items())
                 for m in pattern.finditer(texts[r.doc_id]) if len(m[group]) >= least]
        by = Counter(kind for _, _, kind, _ in found)
        assert (r.n_assign, r.n_access, r.n_hex) == (by["assign"], by["access"], by["hex"])
        names = [f"{kind}:{a}:{e}" for a, _, kind, e in sorted(found)]
        assert r.base_sha256 == sha(",".join(names)) and (not names or set(names) <= set(r.spans.split(",")))


def test_op3_tokens(spark, path, texts):
    from popdist.llm.bpe import load

    exact = load(path).exact
    for r in rows_of(spark, "op3_bpe"):
        ids = exact.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), sha(" ".join(map(str, ids))), sha(exact.decode(ids, skip_special_tokens=False)))


def test_op6_classes(spark, texts):
    got = {r.doc_id: r.class_id for r in rows_of(spark, "op6_jaccard_join")}
    assert got == linked_classes(list(texts.items()))


def test_op7_shards(spark, texts):
    rows = rows_of(spark, "op7_sharding")
    assert len(rows) == len(texts)
    slots, homes, load = defaultdict(list), defaultdict(set), Counter()
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
        slots[r.shard].append(r.slot)
        homes[raw].add(r.shard)
        load[r.shard] += r.size
    assert set(slots) <= set(range(40)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in homes.values())
    groups = Counter()
    for raw, n in Counter(t.encode() for t in texts.values()).items():
        groups[raw] = n * (len(raw) + 16)
    assert max(load.values()) <= sum(load.values()) / 40 + max(groups.values())  # longest processing time


def test_op9_windows(spark, texts):
    first = {}
    words = {i: re.findall("[^\x20\x09-\x0D]+", texts[i]) for i in sorted(texts)}
    for i, ws in words.items():
        for a in range(len(ws) - 49):
            first.setdefault(tuple(ws[a:a + 50]), i)
    for r in rows_of(spark, "op9_substring_dedup"):
        ws = words[r.doc_id]
        gone = {j for a in range(len(ws) - 49) if first[tuple(ws[a:a + 50])] < r.doc_id for j in range(a, a + 50)}
        kept = " ".join(w for j, w in enumerate(ws) if j not in gone)
        assert (r.n_words, r.n_removed, r.kept_sha256) == (len(ws), len(gone), sha(kept))


def test_op10_pieces(spark, path, texts):
    from popdist.llm.bpe import load

    exact = load(path).exact
    ids = {i: [*exact.encode(t, add_special_tokens=False).ids, 2] for i, t in texts.items()}
    assert check_pieces(rows_of(spark, "op10_packing"), ids, 4096) == 0


def test_op5_scores_every_row(spark, texts):
    rows = rows_of(spark, "op5_toxicity")
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)

"""The prefix trie and chat formatting against plain Python."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from popdist.llm import chat_format as cf
from popdist.llm import prefix_trie as pt

WORDS = "[^\x20\x09-\x0D]+"
KIND = "conv_id long, turn long, role string, text string"
#: columns named like the operators' own
CLASH = KIND + ", path string, sid int, block int, seq int, kind string, words int"


def clashing(spark, rows):
    return spark.createDataFrame([(*r, "p", 1, 2, 3, "edit", 4) for r in rows], CLASH)


# -- trie ------------------------------------------------------------------------

def brute_trie(rows):
    import re

    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            sym = hashlib.sha256((str(len(role)) + ":" + role + text).encode()).digest()[:16]
            convs[c].append(((turn is not None, turn or 0, sym), (role, text)))
    own = {c: [t for _, t in sorted(v)] for c, v in convs.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        built[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    members = defaultdict(set)
    for c, p in built.items():
        for d in range(len(p) + 1):
            members[p[:d]].add(c)
    kids = Counter(p[:-1] for p in members if p)
    out = []
    for p, m in members.items():
        below = [q for q in members if q[:len(p)] == p]
        ends = sorted(c for c in m if len(built[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p],
                    sum(not kids[q] for q in below),
                    sum((len(members[q]) - 1) * len(re.findall(WORDS, q[-1][1])) for q in below if q),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return Counter(out)


def made_conversations(seed, n):
    rnd = random.Random(seed)
    texts = ["a b c", "d", "", None, "x  y\tz", "日本 é", "one two three four"]
    rows = []
    for c in range(-5, n):
        for t in range(rnd.randrange(0, 7)):
            rows.append((c, t, ["user", "assistant"][t % 2], texts[rnd.randrange(3) if t < 3 else rnd.randrange(len(texts))]))
    same = [(t, ["user", "assistant"][t % 2], f"same {t}") for t in range(5)]
    rows += [(c, *t) for c in range(1000, 1000 + n) for t in same]  # one conversation, many copies
    rows += [(2000, None, "user", "null turn"), (2000, 3, None, None), (2000, 3, "b", "tie"), (2000, 3, "a", "tie"),
             (2000, 3, "a", "tie"), (None, 0, "user", "nobody"), (2001, 0, "user", "alone")]
    rows += [(3000, t, "user", f"long {t}") for t in range(300)] + [(3001, t, "user", f"long {t}") for t in range(280)]
    return rows


@pytest.mark.parametrize("per_shard", [2, 7, 10_000])
def test_trie_equals_brute_force(spark, per_shard):
    rows = made_conversations(per_shard, 40)
    random.Random(1).shuffle(rows)
    got = pt.conversation_trie(clashing(spark, rows), per_shard)
    assert Counter(map(tuple, got.collect())) == brute_trie(rows)


def test_trie_of_few(spark):
    assert pt.conversation_trie(spark.createDataFrame([], KIND)).collect() == []
    for rows in ([(1, 0, "user", "hi there")], [(3, 0, None, None)], [(None, 0, "a", "b")]):
        got = pt.conversation_trie(spark.createDataFrame(rows, KIND))
        assert Counter(map(tuple, got.collect())) == brute_trie(rows)


def test_long_id_lists_go_in_pieces(spark, monkeypatch):
    rows = [(c, 0, "user", "same") for c in range(20, 20 * 40, 20)] + [(c, 0, "user", "same") for c in range(10_000, 31_000)]
    paths = spark.createDataFrame([(c, b"s" * 16, [3]) for c, *_ in rows], "conv_id long, path binary, words array<long>")
    got = {r.depth: r for r in pt.trie(paths, 15_000).collect()}
    ids = ",".join(str(c) for c in sorted(c for c, *_ in rows))
    assert got[1].ends_sha256 == hashlib.sha256(ids.encode()).hexdigest()
    assert (got[1].n_convs, got[1].saved_tokens, got[0].n_leaves) == (len(rows), 3 * (len(rows) - 1), 1)


def test_skeleton_numbers_are_a_preorder():
    p = lambda s: b"".join(c.encode() * 16 for c in s)
    s = pt.Skeleton([(p("ab"), 1), (p("abc"), 2), (p("ad"), 3), (p("e"), 4)])
    assert s.depth.tolist() == [0, 1, 2, 3, 2, 1] and s.parent.tolist() == [-1, 0, 1, 2, 1, 0]
    assert s.last().tolist() == [5, 4, 3, 3, 4, 5]
    assert s.line(2, p("adx")).tolist() == [0, 1, 4] and s.line(0, p("aa")).tolist() == [0, 1]


# -- chat --------------------------------------------------------------------------

bits = st.lists(st.sampled_from([*cf.CONTROLS, "\\", "<", ">", "[", "]", "s", "/s>", "INST]", " ", "\n", "é", "\\\\", "<<", "SYS>>", "x"]),
                max_size=12).map("".join)
roles = st.one_of(st.sampled_from(["user", "assistant", "system", "", "tool", "other", "role"]), bits)


@settings(max_examples=500, deadline=None)
@given(turns=st.lists(st.tuples(roles, bits), max_size=6))
def test_formatting_reads_back(turns):
    text, loss = "", []
    for role, t in turns:
        piece, span = cf.render(role, t)
        loss += [(len(text) + span[0], len(text) + span[1])] if span else []
        text += piece
    back = cf.parse(text)
    assert [(r, t) for r, t, _, _ in back] == turns
    assert [cf.unescape(text[a:e]) for a, e in loss] == [t for r, t in turns if r == "assistant"]
    # no control string survives inside a text
    assert all(c not in text[a:e] for _, _, a, e in back for c in cf.CONTROLS)


def replay(events):
    """Final (role, text) turns by playing the log in the order of seq."""
    convs = defaultdict(dict)
    for conv, turn, tie, _, kind, role, text in sorted(events, key=lambda e: e[3]):
        now, key = convs[conv], (turn, tie)
        if kind == "message":
            now[key] = [role or "", text or ""]
        elif kind == "regenerate":
            for k in [k for k in now if k[0] > turn]:
                del now[k]
            if key in now:
                now[key][1] = text or ""
        elif key in now:
            now[key][1] = (now[key][1] if kind == "delta" else "") + (text or "")
    return {c: [tuple(now[k]) for k in sorted(now)] for c, now in convs.items()}


def digest(turns, size):
    loss = "".join(t for r, t in turns if r == "assistant")
    body = "".join(f"{r}\n{t}\n" for r, t in turns)
    return (len(turns), hashlib.sha256(body.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), size)


def test_logs_with_edits_and_regenerations(spark):
    rnd = random.Random(5)
    events = []
    for conv in range(60):
        turns = rnd.choice([3, 8, 900])  # the last: several blocks
        for seq in range(turns * 4):
            turn = rnd.randrange(turns)
            kind = rnd.choice(["message"] * 4 + ["delta"] * 5 + ["edit"] + ["regenerate"] * (turns < 10 or rnd.random() < 0.02))
            events.append((conv, turn, "t", seq, kind, rnd.choice(["user", "assistant", "system", "tool", None]),
                           rnd.choice(["a", "<s>", "", None, "x\\", "[INST] q"])))
    rnd.shuffle(events)
    log = spark.createDataFrame([(*e, 1, 2) for e in events], cf.LOG + ", block int, part int")
    parts = cf.format_log(log)
    want = {c: t for c, t in replay(events).items() if t}
    got = {r[0]: tuple(r)[1:] for r in cf.read_back(parts).collect()}
    assert got == {c: digest(t, sum(len(cf.render(*x)[0]) for x in t)) for c, t in want.items()}
    text = defaultdict(str)
    for r in sorted(parts.collect(), key=lambda r: (r.conv_id, r.block, r.part)):
        text[r.conv_id] += r.formatted
    assert {c: [x[:2] for x in cf.parse(t)] for c, t in text.items()} == want


def test_tables_of_turns(spark):
    rows = made_conversations(3, 20) + [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]"),
                                        (5000, 0, "assistant", "long é " * 5000), (5000, 1, "user", "\\")]
    want = defaultdict(list)
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", hashlib.sha256((r[3] or "").encode()).hexdigest())
    for r in sorted((r for r in rows if r[0] is not None), key=order):
        want[r[0]].append((r[2] or "", r[3] or ""))
    got = {r[0]: tuple(r)[1:] for r in cf.chat_digests(clashing(spark, rows)).collect()}
    assert got == {c: digest(t, sum(len(cf.render(*x)[0]) for x in t)) for c, t in want.items()}
    assert cf.chat_digests(spark.createDataFrame([], KIND)).collect() == []

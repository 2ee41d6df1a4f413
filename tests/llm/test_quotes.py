"""Links and threads of conversations against brute force."""

import random
import re

import pytest

from pulseboard.llm import quotes

MESSAGE = "conv_id long, turn long, role string, text string"
COMMON = ["Thanks", "Hello there", "best regards and have a nice day", "ok"]


def slow_links(rows):
    """{index: (conv, turn)} by comparing every quote with every message."""
    parsed = [quotes.parse(t or "") for _, _, _, t in rows]

    def units(k):
        own = parsed[k][0]
        pieces = [own, *re.split(r"\n\s*\n", own), *own.split("\n")]
        return {quotes.key(x) for x in pieces} - {None}

    own = [units(k) for k in range(len(rows))]
    out = {}
    for k, (conv, turn, _, _) in enumerate(rows):
        lines = {quotes.key(x): len(x.split()) for _, p in parsed[k][1] for x in p.split("\n")
                 if quotes.key(x) is not None}
        best = None
        for depth, passage in parsed[k][1]:
            for part, piece in [(0, passage), *((1, x) for x in passage.split("\n"))]:
                h = quotes.key(piece)
                if h is None:
                    continue
                near = [r[1] for j, r in enumerate(rows) if h in own[j] and r[0] == conv
                        and conv is not None and r[1] is not None and turn is not None
                        and r[1] < turn]
                if near:
                    found = (depth, part, 0, 0, -max(near), max(near)), (conv, max(near))
                else:
                    others = {}
                    for j, r in enumerate(rows):
                        if h in own[j] and r[0] is not None and r[0] != conv:
                            others.setdefault(r[0], []).append(r[1])
                    if not others:
                        continue
                    c = min(others)
                    t = min(others[c])
                    texts = set().union(*(own[j] for j, r in enumerate(rows)
                                          if (r[0], r[1]) == (c, t)))
                    agreed = max(len(piece.split()), sum(
                        n for x, n in lines.items() if x in texts))
                    if len(others) > 1 and agreed < quotes.WORDS:
                        continue
                    found = (depth, part, 1, -agreed, c, t), (c, t)
                best = found if best is None or found[0] < best[0] else best
        if best:
            out[k] = best[1]
    return out


def slow_threads(heads):
    heads = dict(heads)
    for v in sorted(heads):  # the smallest id of each circle
        seen, x = [], v
        while x in heads and x not in seen:
            seen.append(x)
            x = heads[x]
        if x in heads:
            circle = seen[seen.index(x):]
            if v == min(circle):
                del heads[v]
    out = {}
    for v in heads:
        x, depth = v, 0
        while x in heads:
            x, depth = heads[x], depth + 1
        out[v] = (x, depth)
    return out


def made(seed):
    rng = random.Random(seed)
    rows, texts = [], []
    for conv in rng.sample(range(1, 200), 40):
        for turn in range(rng.randrange(1, 5)):
            lines = [rng.choice(COMMON) if rng.random() < .3 else " ".join(
                f"w{rng.randrange(40)}" for _ in range(rng.randrange(1, 9)))
                for _ in range(rng.randrange(1, 4))]
            quoted = []
            if texts and rng.random() < .6:
                source = rng.choice(texts)
                part = source[:rng.randrange(1, len(source) + 1)]
                quoted = [rng.choice(["> ", ">> "]) + x for x in part]
            if rng.random() < .2:
                quoted.append("> " + rng.choice(COMMON))
            texts.append(lines)
            rows.append((conv, turn, "user", "\n".join(quoted + lines)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_links_against_brute_force(spark, seed):
    rows = made(seed)
    got = quotes.link_conversations(spark.createDataFrame(rows, MESSAGE)).collect()
    want = slow_links(rows)
    linked = {(r["conv_id"], r["turn"]): (r["reply_conv"], r["reply_turn"])
              for r in got if r["quote_linked"]}
    assert linked == {(rows[k][0], rows[k][1]): to for k, to in want.items()}
    assert any(c > own for (own, _), (c, _) in linked.items())  # to larger ids too
    at = {(r["conv_id"], r["turn"]): (r["thread_id"], r["position"]) for r in got}
    assert len(set(at.values())) == len(rows)
    heads = {c: linked[c, 0][0] for c, t in at if t == 0 and (c, 0) in linked
             and linked[c, 0][0] != c}
    roots = slow_threads(heads)
    for (c, t), (thread, place) in at.items():
        assert thread == roots.get(c, (c, 0))[0]
    for c, to in heads.items():  # an answer comes after, unless it closed a circle
        if c in roots:
            assert at[c, 0][1] > at[to, 0][1]


def test_many_holders_and_larger_ids(spark):
    sentence = "a sentence of nine words that many of them hold"
    rows = [(i, 0, "user", sentence) for i in range(20, 60)]
    rows += [(70, 0, "user", f"> {sentence}\nYes"), (10, 0, "user", "> quite rare\nNo"),
             (50, 1, "user", "quite rare"), (80, 0, "user", "> Thanks\n> ok\nWell"),
             (81, 0, "user", "Thanks\nok"), (82, 0, "user", "Thanks\nok")]
    got = {(r["conv_id"], r["turn"]): r for r in quotes.link_conversations(
        spark.createDataFrame(rows, MESSAGE).withColumn("hash", quotes.F.lit(1))).collect()}
    assert (got[70, 0]["reply_conv"], got[70, 0]["thread_id"]) == (20, 20)
    assert (got[10, 0]["reply_conv"], got[10, 0]["reply_turn"]) == (50, 1)
    assert not got[80, 0]["quote_linked"]  # three words that several hold say nothing


def test_circles_are_broken_at_their_smallest_id(spark):
    heads = {5: 9, 9: 7, 7: 5, 3: 9, 20: 3, 30: 31, 31: 30, 40: 41, 1: 30}
    got = quotes.threads(spark.createDataFrame(list(heads.items()), "conv_id long, parent long"))
    assert {r["conv_id"]: (r["thread_id"], r["depth"]) for r in got.collect()} == slow_threads(
        heads)


def test_very_long_and_blank_messages(spark):
    long = "\n".join(f"line {k} of a very long message" for k in range(30000))
    rows = [(1, 0, "u", long), (2, 0, "u", "> line 29999 of a very long message\nIs it?"),
            (None, 1, "u", "> " + "x" * 200000), (None, None, None, None), (None, 1, "u", ""),
            (3, None, "u", "ok"), (3, 0, "u", "\n\n")]
    got = quotes.link_conversations(spark.createDataFrame(rows, MESSAGE)).collect()
    assert len(got) == len(rows)
    assert [r["reply_conv"] for r in got if r["conv_id"] == 2] == [1]
    assert sorted(r["position"] for r in got if r["conv_id"] is None) == [1, 2, 3]

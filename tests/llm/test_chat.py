import random
import re

import pytest

from civiclake.llm import chat
from conftest import rows


def level_and_rest(line):
    mark = re.match(r"^((?:[ \t]*>)+)", line)
    return (mark[1].count(">"), line[mark.end() :]) if mark else (0, line)


def norm(line):
    return re.sub(r"[\W_]+", " ", line.lower()).strip()


def message_units(text):
    """(level, unit) of all lines, and of the sentences of passages of several lines."""
    passages = []
    for n, rest in map(level_and_rest, (text or "").split("\n")):
        if passages and passages[-1][0] == n:
            passages[-1][1].append(rest)
        else:
            passages.append((n, [rest]))
    found = []
    for n, lines in passages:
        found += [(n, norm(line)) for line in lines]
        if len(lines) > 1:
            found += [(n, norm(part)) for part in re.split("[.!?]+", " ".join(lines))]
    return [u for u in found if u[1]]


def brute(messages):
    replies, linked = {}, {}
    keyed = [m for m in messages if m[0] is not None and m[1] is not None]
    for c, t in {m[:2] for m in keyed}:
        same = [m for m in keyed if m[0] == c]
        votes, linked[c, t] = {}, 0
        for _, _, _, y in [m for m in same if m[1] == t]:
            for n, unit in message_units(y):
                origins = [u for _, u, _, z in same if u < t and (0, unit) in message_units(z)] if n else []
                if origins:
                    votes[n, max(origins)] = votes.get((n, max(origins)), 0) + 1
                    linked[c, t] += 1
        earlier = [m[1] for m in same if m[1] < t]
        best = max(votes, key=lambda s: (-s[0], votes[s], s[1])) if votes else (0, max(earlier, default=None))
        replies[c, t] = best[1]

    def begin(c, t, whole):
        up = replies[c, t]
        first = up is not None and t == min(u for d, u in replies if d == c and replies[d, u] == up)
        return t if up is None or not (whole or first) else begin(c, up, whole)

    out = []
    for c, t, r, x in messages:
        levels = [level_and_rest(line)[0] for line in (x or "").split("\n")]
        text = "\n".join(line for line, n in zip((x or "").split("\n"), levels) if n == 0).strip(" ")
        key = (c, t)
        trees = (begin(c, t, True), begin(c, t, False)) if key in replies else (None, None)
        quoted = sum(n > 0 for n in levels)
        out.append((c, t, r, replies.get(key), *trees, quoted, max(levels), linked.get(key, 0), text, f"<|{r or 'user'}|>\n{text}\n"))
    return sorted(out, key=repr)


def fixture():
    rng = random.Random(9)
    messages = []
    for c in range(12):
        said = []
        for t in range(0, rng.randint(1, 9) * 2, 2):
            lines = []
            for _ in range(rng.randint(0, 2)):
                if said:
                    lines += ["> " + line for line in rng.choice(said).split("\n")][: rng.randint(1, 4)]
            lines += [rng.choice(["Yes.", "no, never", "see you", "the  Answer: 42", "ok é"]) for _ in range(rng.randint(0, 3))]
            said.append("\n".join(lines))
            messages.append((c, t, rng.choice(["user", "assistant", None]), said[-1]))
    messages += [(50, 1, "user", None), (50, 2, "user", ""), (None, 1, "user", "> x"), (51, None, "system", ">> deep\n >a\nb")]
    wrapped = "The quick brown fox\njumps over the lazy dog. It then sleeps."
    messages += [
        (60, 1, "user", wrapped), (60, 2, "assistant", "A reply in between\n> It then sleeps."), (60, 3, "user", ">> the quick brown\n>> fox jumps over\n>> the lazy dog.\nnested only"),
        (60, 4, "user", "> nested only\n>> a reply in between\nboth levels"), (60, 5, "user", "> A reply in between\nto two"), (60, 6, "user", "> both levels\nand on"), (60, 7, "user", "last"),
        (60, 8, "user", ">  > nested\tonly\n\x01odd\x02 marks\x03 here"), (60, 9, "user", ">odd marks here"), (60, 10, "user", "> a reply in between"),
    ]
    return messages + [messages[1], messages[5], (0, 2, "user", "> yes\nother"), (52, 0, "user", "long " * 50000 + "\n>" * 40)]


@pytest.mark.parametrize("turns", [4096, 3])
def test_against_brute_force(spark, monkeypatch, turns):
    monkeypatch.setattr(chat, "SLICE_TURNS", turns)
    messages = fixture()
    df = spark.createDataFrame(messages, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS reply_to", "2 AS t", "3 AS c")
    assert rows(chat.format_chats(df)) == brute(messages)


def test_nested_wrapped_and_branching_quotes(spark):
    df = spark.createDataFrame(fixture(), "conv_id long, turn long, role string, text string").where("conv_id = 60")
    got = {r.turn: r for r in chat.format_chats(df).collect()}
    assert got[3].reply_to == 1 and got[3].n_linked == 1 and got[3].own_text == "nested only"  # quoted at level 2 alone, wrapped elsewhere
    assert got[4].reply_to == 3 and got[4].n_linked == 2  # the outermost level decides
    order = [r.turn for r in sorted(got.values(), key=lambda r: (r.branch, r.turn))]
    for r in got.values():
        assert r.thread == 1 and (r.reply_to is None or order.index(r.reply_to) < order.index(r.turn))
    assert len({r.branch for r in got.values()}) > 2


def test_sql_gives_the_same_rows(spark):
    import duckdb

    import pyarrow as pa

    from civiclake.llm.oracles import CHAT

    names = ["conv_id", "turn", "role", "text"]
    conversations = pa.table({n: list(c) for n, c in zip(names, zip(*fixture()))})  # noqa: F841
    assert sorted(duckdb.sql(CHAT).fetchall(), key=repr) == brute(fixture())


def test_empty_and_native(spark):
    df = spark.createDataFrame(fixture(), "conv_id long, turn long, role string, text string")
    assert chat.format_chats(df.limit(0)).isEmpty()
    plan = chat.format_chats(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan

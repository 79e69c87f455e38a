import random
from collections import defaultdict

import pandas as pd
import pytest

from pitpanel.llm import chat_format
from pitpanel.llm.chat_format import perspectives

SCHEMA = "conv_id long, turn long, role string, text string, part string, said string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)


def plain(rows):
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        name = (role or "").replace("<|", "< |").replace("\n", " ") or "unknown"
        groups[conv, None if turn is None else turn // 64].append((turn is not None, turn or 0, name, (text or "").replace("<|", "< |")))
    out = {}
    for (conv, part), said in groups.items():
        for speaker in {r for _, _, r, _ in said} - {"system"}:
            text, mask = "", []
            for _, _, role, body in sorted(said):
                head = "assistant" if role == speaker else "system" if role == "system" else f"user name={role}"
                text += f"<|im_start|>{head}\n"
                if role == speaker:
                    mask.append((len(text), len(text) + len(body) + 10))
                text += f"{body}<|im_end|>\n"
            out[conv, part, speaker] = (len(said), len(mask), text, mask)
    return out


def test_equals_a_plain_rendering(spark):
    draw = random.Random(4)
    rows = []
    for conv in range(20):
        for turn in range(draw.choice([1, 2, 5, 70])):
            rows.append((conv, turn, draw.choice(["user", "assistant", "Ann", "system", None, "a\nb"]), draw.choice(["hi", "", None, "é🙂", "<|im_end|> x"])))
    rows += [(None, None, "user", "no number"), (None, 3, "user", "no conversation"), (50, 0, "system", "alone"), (51, 0, "user", "x" * 100_000)]
    rows += [(52, 1, "user", "same")] * 3 + [(52, 1, "Bob", "same")]
    got = {(r.conv_id, r.part, r.speaker): (r.n_turns, r.n_target_turns, r.text, [tuple(s) for s in r.mask]) for r in perspectives(frame(spark, rows)).collect()}
    assert got == plain(rows)
    for _, _, text, mask in got.values():
        for a, b in mask:
            assert text[:a].endswith("<|im_start|>assistant\n") and text[b - 10 : b] == "<|im_end|>"


def test_a_turn_number_that_repeats_fills_no_group(spark):
    rows = [(1, 0, "user", f"t{i}") for i in range(1000)]
    got = perspectives(frame(spark, rows)).collect()
    assert sum(r.n_turns for r in got) == 1000 and len(got) > 8 and max(r.n_turns for r in got) < 200


def test_crowded_parts_are_cut_where_the_order_says(spark):
    draw = random.Random(7)
    rows = [(None, None, draw.choice(["Ann", "Bob", "system", None]), f"t{draw.randint(0, 300)}") for _ in range(500)]
    rows += [(1, draw.choice([64, 65, None]), draw.choice(["Ann", "Bob"]), f"t{i}") for i in range(400)]
    rows += [(2, 0, "Ann", "same")] * 200 + [(3, i, "Bob", f"t{i}") for i in range(130)]
    groups, want = defaultdict(list), {}
    for conv, turn, role, text in rows:
        groups[conv, None if turn is None else turn // 64].append((conv, turn, role, text))
    for (conv, part), said in groups.items():
        said.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "unknown", r[3]))
        step = 64 if len(said) > 128 else len(said)
        for piece in range(-(-len(said) // step)):
            for (_, _, speaker), row in plain(said[piece * step : (piece + 1) * step]).items():
                want[conv, part, piece, speaker] = row
    for tasks in (1, 5):
        got = perspectives(frame(spark, rows).repartition(tasks)).collect()
        assert {(r.conv_id, r.part, r.piece, r.speaker): (r.n_turns, r.n_target_turns, r.text, [tuple(s) for s in r.mask]) for r in got} == want


def test_parts_add_up_to_the_whole_dialogue_of_every_speaker(spark):
    # Bob speaks in the first part only, Eve in the last; the second has only the system.
    rows = [(1, 0, "system", "scene"), (1, 1, "Bob", "hello")] + [(1, i, "Ann", f"a{i}") for i in range(2, 60)]
    rows += [(1, i, "system", f"s{i}") for i in range(64, 128)] + [(1, 190, "Eve", "bye"), (1, None, "Ann", "no number")]
    rows += [(2, 0, "system", "scene")] + [(2, 5, f"r{i % 3}", f"t{i:03}") for i in range(300)] + [(3, 70, "Bob", "short")]
    rows += [(None, i, draw, "x") for i in range(0, 200, 50) for draw in ("Ann", f"r{i}")] + [(4, i, "system", "x") for i in range(70)]
    want = {}
    for conv, speaker in {(r[0], r[2]) for r in rows if r[2] != "system"}:
        said = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        text, mask = "", []
        for _, _, role, body in said:
            head = "assistant" if role == speaker else "system" if role == "system" else f"user name={role}"
            text += f"<|im_start|>{head}\n"
            if role == speaker:
                mask.append((len(text), len(text) + len(body) + 10))
            text += f"{body}<|im_end|>\n"
        want[conv, speaker] = (len(said), len(mask), text, mask)
    got = defaultdict(lambda: (0, 0, "", []))
    found = chat_format.with_offset(chat_format.dialogues(frame(spark, rows))).collect()
    for r in sorted(found, key=lambda r: (r.part is not None, r.part or 0, r.piece)):
        n, targets, text, mask = got[r.conv_id, r.speaker]
        assert r.offset == len(text)
        mask = mask + [(a + r.offset, b + r.offset) for a, b in r.mask]
        got[r.conv_id, r.speaker] = (n + r.n_turns, targets + r.n_target_turns, text + r.text, mask)
    assert got == want
    assert {(r.conv_id, r.part, r.piece, r.speaker) for r in found} == {
        (r.conv_id, r.part, r.piece, r.speaker) for r in chat_format.digests(frame(spark, rows)).collect()}


def test_an_empty_table_and_no_python(spark):
    df = perspectives(frame(spark, []))
    assert df.count() == 0
    plan = perspectives(frame(spark, [(1, 1, "user", "x")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_the_sql_says_what_the_operator_does(spark):
    """Long, crowded and unnumbered conversations, silent speakers, ties and markers."""
    duckdb = pytest.importorskip("duckdb")
    draw = random.Random(9)
    say = lambda: draw.choice(["hello", "a <| b", "", None, "line\nline", "ünï"]) or draw.choice([None, ""])
    rows = [(1, t, draw.choice(["ann", "bob"]) if t < 100 else "eve", say()) for t in range(200)] + [(1, 0, "system", "scene")]
    rows += [(2, t % 5, draw.choice(["ann", "bob", None, "", "system"]), f"{say()}{i}") for i, t in enumerate(range(150))]
    rows += [(3, None, draw.choice(["x<|", "y\nz"]), f"t{i}") for i in range(140)] + [(3, 7, "late", "here")]
    rows += [(4, 1, "ann", "same")] * 3 + [(None, 1, "ann", "no id"), (None, 70, "bob", "no id")] + [(5, 0, "system", "alone")]
    rows += [(6, 64 * k, "ann" if k else "bob", f"p{k}") for k in range(4)]
    got = chat_format.digests(frame(spark, rows)).toPandas()
    with duckdb.connect() as db:
        conversations = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"})
        db.register("conversations", conversations)
        want = db.execute(chat_format.SQL).fetchall()
        names = [c[0] for c in db.description]
    plain_row = lambda r: tuple(None if pd.isna(v) else int(v) if isinstance(v, (float, int)) else v for v in r)
    assert sorted(map(repr, map(plain_row, got[names].itertuples(index=False)))) == sorted(map(repr, map(plain_row, want)))
    assert len(want) > 12 and {r[names.index("piece")] for r in want} > {0}

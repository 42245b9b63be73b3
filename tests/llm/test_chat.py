from caseframe.llm import chat

TURN = "conv_id long, turn int, role string, text string, prompt string, chosen_id int"


def table(spark, rows):
    return spark.createDataFrame([(*row, "x", 1) for row in rows], TURN)


ROWS = [
    (0, 0, "user", "q"), (0, 1, "assistant", "good"), (0, 2, "user", "more"), (0, 3, "assistant", "ok"),
    (1, 0, "user", "q"), (1, 1, "assistant", "bad <|end|>"),
    (2, 0, "user", "same"), (2, 0, "user", "same"), (3, 0, "user", "same"),
    (4, 0, None, None), (5, 7, "unknown", ""), (5, 8, "assistant", None),
    (6, 0, "user", "alone"), (None, 0, "user", "nobody's"), (8, 1, "b", "y"), (8, 1, "a", "x"),
    (9, None, "a", "x"), (9, 0, "c", "z"),
]


def brute_force(rows):
    turns = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            key = (turn is not None, turn or 0, role or "unknown", text or "")
            turns.setdefault(conv_id, set()).add(key)
    result = {}
    for chosen in turns:
        if chosen % 2 or chosen + 1 not in turns:
            continue
        sides = [[turn[2:] for turn in sorted(turns[one])] for one in (chosen, chosen + 1)]
        common = 0
        while common < min(map(len, sides)) and sides[0][common] == sides[1][common]:
            common += 1
        rendered = []
        for part in (sides[0][:common], sides[0][common:], sides[1][common:]):
            text, mask = "", []
            for role, body in part:
                text += f"<|{role}|>\n"
                start = len(text)
                text += body.replace("<|", "< |") + "<|end|>\n"
                if role == "assistant":
                    mask.append((start, len(text)))
            rendered.append((text, mask))
        result[chosen] = (common, rendered[0][0], rendered[1], rendered[2])
    return result


def found_rows(df):
    return {
        row["chosen_id"]: (
            row["n_common"],
            row["prompt"],
            (row["chosen"], [tuple(span) for span in row["chosen_mask"]]),
            (row["rejected"], [tuple(span) for span in row["rejected_mask"]]),
        )
        for row in df.collect()
    }


def test_pairs_equal_brute_force(spark):
    df = table(spark, ROWS)
    pairs = chat.adjacent_pairs(df)
    assert found_rows(chat.preference_pairs(df, pairs)) == brute_force(ROWS)


def test_masks_cover_assistant_texts(spark):
    (row,) = chat.preference_pairs(
        table(spark, ROWS), spark.createDataFrame([(0, 1), (0, 77)], "chosen_id long, rejected_id long")
    ).collect()
    assert row["prompt"] == "<|user|>\nq<|end|>\n"
    learnt = [row["chosen"][span["start"] : span["end"]] for span in row["chosen_mask"]]
    assert learnt == ["good<|end|>\n", "ok<|end|>\n"]
    assert row["rejected"] == "<|assistant|>\nbad < |end|><|end|>\n"


def test_empty(spark):
    df = table(spark, [])
    assert chat.preference_pairs(df, chat.adjacent_pairs(df)).count() == 0

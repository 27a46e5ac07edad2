import random

from lodestone.llm import conversations

SCHEMA = "entry_id string, role string, content string, session_tag string, timestamp double, tool_call_id string, at int, rank string, t string"


def frame(spark, rows):
    full = [(*r, None, None)[:6] + (k, "x", "y") if len(r) == 5 else (*r, k, "x", "y") for k, r in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA).selectExpr("*", "timestamp_seconds(at) ingested_at")


def brute(rows):
    rank = {"system": 0, "user": 1, "tool": 2, "assistant": 3, None: 4}
    by = {}
    for r in rows:
        by.setdefault(r[3], []).append(r)
    out = {}
    for tag, ms in by.items():
        ms.sort(key=lambda r: (r[4], rank[r[1]], r[0]))
        ua = [(r[1], bool((r[2] or "").strip())) for r in ms if r[1] in ("user", "assistant")]
        calls = {r[5] for r in ms if r[1] == "assistant"} - {None}
        runs = []
        for role, seen in ua:
            if runs and runs[-1][0] == role:
                runs[-1][1] |= seen
            else:
                runs.append([role, seen])
        if not any(s for _, s in ua):
            out[tag] = "empty"
        elif ua[0][0] == "assistant" or any(r[1] is None for r in ms) or any(r[1] == "tool" and r[5] not in calls for r in ms):
            out[tag] = "broken"
        elif any(x[0] == "user" and (k + 1 == len(runs) or not runs[k + 1][1]) for k, x in enumerate(runs)):
            out[tag] = "missing_reply"
    return out


def test_against_brute_force_with_a_hot_session(spark):
    random.seed(4)
    rows = []
    for k in range(3000):
        tag = "hot" if random.random() < 0.35 else f"s{random.randrange(300)}"
        role = random.choices(["user", "assistant", "system", "tool", None], [40, 50, 4, 3, 1])[0]
        call = f"c{random.randrange(40)}" if role == "tool" or (role == "assistant" and random.random() < 0.5) else None
        rows.append((f"e{k}", role, random.choice(["hello words here", "other words", None, " "]), tag, float(random.randrange(2000)), call))
    got = conversations.rebuild(frame(spark, rows))
    assert {r.session_tag: r.reason for r in got.dropped.collect()} == brute(rows)
    hot = [r for r in got.messages.collect() if r.session_tag == "hot"]
    assert sorted(r.position for r in hot) == list(range(1, len(hot) + 1))


def test_edge_cases(spark):
    rows = [
        ("a:10:x", " User ", "hi", " Tag ", None), ("a:10:x", None, "hi", "TAG", None), ("a:11:y", "llm", "yes", "tag", 11000000000000.0 / 1e0),
        ("b1", "user", None, "empty", 1.0), ("b2", "assistant", "​", "empty", 2.0),
        ("c1", "human", "q", None, 1.0), (None, "user", "q", "tag", 5.0),
        ("d1", "system", "only", "sys", 1.0),
    ]
    df = frame(spark, rows)
    got = conversations.rebuild(df)
    assert {r.session_tag: r.reason for r in got.verdicts.collect()} == {"tag": None, "empty": "empty", "sys": "empty"}
    assert [(r.entry_id, r.role, r.tree_id) for r in got.with_trees.orderBy("position").collect()] == [("a:10:x", "user", "a:10:x"), ("a:11:y", "assistant", "a:10:x")]
    assert conversations.rebuild(df.limit(0)).verdicts.count() == 0


def test_reply_prefers_the_prompt_it_speaks_of(spark):
    rows = [
        ("1", "user", "how does vector quantisation behave", "x", 1.0), ("2", "user", "when will shipping addresses update", "x", 2.0),
        ("3", "assistant", "vector quantisation behave like this", "x", 3.0), ("4", "assistant", "shipping addresses update nightly", "x", 4.0),
    ]
    got = {r.entry_id: r.parent_id for r in conversations.rebuild(frame(spark, rows)).messages.collect()}
    assert got == {"1": None, "2": "1", "3": "1", "4": "2"}  # the second prompt continues the first


def test_a_long_reply_is_compared_by_all_its_words(spark):
    filler = [f"filler{a}{b}" for a in "abcdefghij" for b in "abcdefghij"]
    rows = [
        ("1", "user", "how does vector quantisation behave", "x", 1.0), ("2", "user", "when will shipping addresses update", "x", 2.0),
        ("3", "assistant", " ".join(["vector quantisation does behave", *filler]), "x", 3.0),
        ("4", "assistant", " ".join(["it is on sundays that shipping addresses update", *filler]), "x", 4.0), ("5", "user", "thanks then", "x", 3.5),
    ]
    got = {r.entry_id: r.parent_id for r in conversations.rebuild(frame(spark, rows)).messages.collect()}
    assert got == {"1": None, "2": "1", "3": "1", "4": "2", "5": None}


def test_links_reach_any_number_of_messages_back_and_do_not_hang_on_partitions(spark):
    rows = [("q0", "user", "the colour of zirconium crystals", "x", 0.0)]
    rows += [(f"m{k:03d}", "assistant" if k % 2 else "user", f"something else {k % 2}", "x", 1.0 + k) for k in range(200)]
    rows += [("r0", "assistant", "zirconium crystals are of a blue colour", "x", 230.0), ("r1", "assistant", "very late", "x", 9000.0), ("f", "user", "zirconium crystals of blue colour then?", "x", 9001.0)]
    rows += [("y0", "user", "see order AB-12345 please", "y", 0.0), ("y1", "user", "and the weather", "y", 1.0), ("y2", "assistant", "AB-12345 has gone out", "y", 2.0)]
    seen = []
    for parts in ("1", "4", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = conversations.rebuild(frame(spark, rows))
        links = {r.entry_id: (r.parent_id, r.link, r.position, r.head_id) for r in got.messages.collect()}
        seen.append((links, sorted(map(tuple, got.verdicts.collect()))))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert seen[0] == seen[1] == seen[2]
    assert links["r0"][:2] == ("q0", "replies") and links["r1"][:2] == ("m198", "replies late") and links["y2"][0] == "y0"
    tree = {r.entry_id: r.tree_id for r in got.with_trees.collect()}
    assert tree["y2"] == tree["y1"] == "y0"


def test_a_prompt_follows_up_the_reply_it_speaks_of(spark):
    rows = [
        ("1", "user", "how does vector quantisation behave", "x", 1.0), ("2", "assistant", "quantisation halves memory", "x", 2.0),
        ("3", "user", "quantisation halves what?", "x", 3.0), ("4", "assistant", "the memory", "x", 4.0), ("5", "user", "unrelated question", "x", 5.0), ("6", "assistant", "fine", "x", 6.0),
    ]
    got = conversations.rebuild(frame(spark, rows))
    assert {r.entry_id: r.tree_id for r in got.with_trees.collect()} == {"1": "1", "2": "1", "3": "1", "4": "1", "5": "5", "6": "5"}

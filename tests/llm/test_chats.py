import duckdb
from compare import difference

from wattlake.llm import chats, sql

ROWS = [
    (1, 0, "user", "Hello there.\nHow are  you?\n\nSecond paragraph\nwraps here."),
    (1, 1, "assistant", "> hello there.\n> How are you?\n\nFine."),
    (1, 2, "user", "On Monday A wrote:\n> > Hello there.\n> > How are you?\n>\n> Fine.\n\nGood!"),
    (1, 3, "user", ">second paragraph wraps\n> here.\n>> nothing\nreply to p2"),
    (1, 4, "assistant", "> Good!\nok"), (1, 5, None, None), (1, 6, "user", ""), (1, 7, "user", "> never said\n  only me "),
    (1, 7, "user", "> Fine.\ndup"), (None, 1, "user", "> Fine."), (2, None, "user", "> x"), (2, 1, "user", "> Good!\nno"),
    (3, 0, "user", "> a"), (3, 1, "user", ">>>>> a\r\n>b\r\nb"), (3, 2, "x", "> b"),
    (4, 0, "user", "one\ntwo"), (4, 1, "user", "two\nthree"), (4, 2, "user", "> one\n> two\n> three"), (4, 3, "user", "> two"),
    (4, 4, "user", "later"), (4, 5, "user", "> later\n> > one\nmixed"),
]
SCHEMA = "conv_id long, turn long, role string, text string"


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", hash string, level long")
    return df, chats.conversations(df)


def test_links_threads_and_texts(spark):
    got = {(r.conv_id, r.turn, r.message): (r.parent_turn, r.thread_turn, r.quote_levels) for r in run(spark, ROWS)[1].collect()}
    assert len(got) == len(ROWS)
    assert got[1, 1, "<|assistant|>\nFine.<|end|>"] == (0, 0, 1)
    assert got[1, 2, "<|user|>\nGood!<|end|>"] == (1, 0, 2)
    assert got[1, 3, "<|user|>\nreply to p2<|end|>"] == (0, 0, 2)
    assert got[1, 4, "<|assistant|>\nok<|end|>"] == (2, 0, 1)
    assert got[1, 5, "<|unknown|>\n<|end|>"] == (None, 5, 0)
    assert got[2, 1, "<|user|>\nno<|end|>"] == (None, 1, 1)  # said in another conversation
    assert got[4, 2, "<|user|>\n<|end|>"] == (0, 0, 1)  # two of its passages are from there
    assert got[4, 5, "<|user|>\nmixed<|end|>"] == (4, 4, 2)


def test_equals_sql(spark):
    df, got = run(spark, ROWS)
    con = duckdb.connect()
    con.register("conversations", df.toArrow())
    assert difference(got, con, sql.chat_conversations()) is None


def test_long_chain_of_answers(spark):
    rows = [(9, 0, "u", "m0")] + [(9, i, "u", f"> m{i - 1}\nm{i}") for i in range(1, 70)]
    got = run(spark, rows)[1].collect()
    assert {r.thread_turn for r in got} == {0} and all(r.parent_turn == r.turn - 1 for r in got if r.turn)


def test_every_message_follows_what_it_answers(spark):
    ordered = sorted(((r.thread_turn, r.turn), r) for r in run(spark, ROWS)[1].where("conv_id = 4").collect())
    seen = set()
    for _, r in ordered:
        assert r.parent_turn is None or r.parent_turn in seen
        seen.add(r.turn)


SIGNED = "\n\nKind regards from the whole team\nTel. 12 34 56"
SHARED = [  # greeting and signature are in every message; what is quoted tells which one is meant
    (5, 0, "a", f"Dear all,\n\nOn Monday.{SIGNED}"), (5, 1, "b", f"Dear all,\n\nYes.{SIGNED}"),
    (5, 2, "c", "> Dear all,\n>\n> Yes.\n>\n> Kind regards from the whole team\n> Tel. 12 34 56\nquoted in full"),
    (5, 3, "d", "> Yes.\n>\n> Kind regards from the whole\n> team Tel. 12 34 56\nwithout the greeting"),
    (5, 4, "e", "> Dear all,\nthe greeting alone"),
    (6, 0, "a", "ok, later\nfine"), (6, 1, "b", "fine"), (6, 2, "c", "> fine\nx"),
    (6, 3, "d", "> Fine\n> ok, later\nlines in another order"),
    (7, 0, "a", "same"), (7, 1, "b", "same"), (7, 2, "c", "> same\nfirst of equal messages"),
]


def test_shared_passages_do_not_decide(spark):
    df, got = run(spark, SHARED)
    parents = {(r.conv_id, r.turn): r.parent_turn for r in got.collect() if r.parent_turn is not None}
    assert parents == {(5, 2): 1, (5, 3): 1, (5, 4): 0, (6, 2): 1, (6, 3): 0, (7, 2): 0}
    con = duckdb.connect()
    con.register("conversations", df.toArrow())
    assert difference(got, con, sql.chat_conversations()) is None


def test_messages_without_a_key_join_nothing(spark):
    rows = [(None, i % 3 or None, "u", f"> m\nsaid {i}") for i in range(40)] + [(8, None, "u", "> m"), (8, 0, "u", "m"), (8, 1, "u", "> m")]
    got = run(spark, rows)[1].collect()
    assert len(got) == len(rows)
    assert [(r.turn, r.parent_turn) for r in got if r.parent_turn is not None] == [(1, 0)]
    assert all(r.thread_turn == r.turn for r in got if r.parent_turn is None)


def test_long_texts_are_parsed_whole(spark):
    long = "\n".join(f"line {i} of a long message" for i in range(20_000))
    quote = "\n".join("> " + x for x in long.split("\n"))
    got = run(spark, [(1, 0, "u", "line 1 of a long message"), (1, 1, "u", long), (1, 2, "u", quote + "\nread")])[1].collect()
    assert {r.turn: r.parent_turn for r in got} == {0: None, 1: None, 2: 1}
    assert {r.message for r in got if r.turn == 2} == {"<|u|>\nread<|end|>"}


def test_no_rows(spark):
    assert run(spark, [])[1].count() == 0

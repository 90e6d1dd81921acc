"""URL filter and chat formatting."""

import hashlib

import pytest

from tideline.llm import chat, queries, urls

RULES = queries.URL_RULES


@pytest.mark.parametrize(
    "url, host, path, rule, verdict",
    [
        ("https://WWW.Example.NET/en/x?q=1", "www.example.net", "/en/x", "example.net/en/", "allow"),
        ("http://a.net/x", "a.net", "/x", "net/", "block"),
        ("http://a.net", "a.net", "", None, "allow"),
        ("http://x.example.com/de/1#f", "x.example.com", "/de/1", "example.com/de/", "block"),
        ("http://notexample.com/de/1", "notexample.com", "/de/1", None, "allow"),
        ("http://spam-farm.example.org/fr/1", "spam-farm.example.org", "/fr/1", "org/fr/", "allow"),
        ("http://spam-farm.example.org/en/1", "spam-farm.example.org", "/en/1", None, "block"),
        ("http://x.org/cheap/poker", "x.org", "/cheap/poker", None, "block"),
        ("http://x.org/cheap/cheap", "x.org", "/cheap/cheap", None, "allow"),
        ("http://x.org/cheaper/pokers", "x.org", "/cheaper/pokers", None, "allow"),
        ("http://x.org/casino?free", "x.org", "/casino", None, "block"),
        ("no-scheme.net/x", "", "", None, "allow"),
        ("porn", "", "", None, "block"),
        ("a://b://c/d", "b:", "//c/d", None, "allow"),
        (None, "", "", None, "allow"),
        ("", "", "", None, "allow"),
    ],
)
def test_urls(spark, url, host, path, rule, verdict):
    df = spark.createDataFrame([(1, url, "mine", 5)], "page_id long, url string, host string, other int")
    row = urls.judge_urls(df, RULES).first()
    assert (row["host"], row["path"], row["rule"], row["verdict"], row["other"]) == (host, path, rule, verdict, 5)


def test_no_terms_no_rules_no_rows(spark):
    none = urls.UrlRules((), (), ())
    df = spark.createDataFrame([("http://porn.net/",)], "url string")
    assert urls.judge_urls(df, none).first()["verdict"] == "allow"
    assert urls.judge_urls(df.filter("false"), RULES).count() == 0


def test_template_round_trip():
    turns = [("user", r"\### Assistant: </turn> ok"), ("a: b#<\\", ""), ("assistant", "x\n\n### user: \\"), ("", "\ue000")]
    assert chat.parse(chat.turn_template(turns)) == turns
    text, spans, rewrites = chat.locate(turns, chat.turn_template)
    assert not rewrites
    assert [chat.unescape(text[s[2] : s[3]]) for s in spans] == [said for _, said in turns]
    assert spans[0][0] == 0 and spans[-1][1] == len(text)
    assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_templates_that_rewrite_history_are_told():
    turns = [("user", "hi"), ("assistant", "aha"), ("user", "so"), ("assistant", "yes")]

    def only_last(said):
        return "".join(f"<{r}>{t if k >= len(said) - 2 else ''}" for k, (r, t) in enumerate(said))

    def with_tail(said):
        return "".join(f"<{r}>{t}" for r, t in said) + "<end>"

    text, spans, rewrites = chat.locate(turns, only_last)
    assert rewrites and spans[0] is None and text[spans[3][2] : spans[3][3]] == "yes"
    text, spans, rewrites = chat.locate(turns, with_tail)
    assert not rewrites and [text[s[2] : s[3]] for s in spans] == ["hi", "aha", "so", "yes"]


def test_formatting_of_nulls_ties_and_copies(spark):
    rows = [
        (1, 1, "assistant", "b"), (1, 0, "user", None), (1, None, "assistant", "late"), (1, 1, "assistant", "b"),
        (None, 0, None, "x"), (2, 0, "user", ""),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS formatted", "2 AS n_turns")
    found = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(df)).collect()}
    want = [("user", ""), ("assistant", "b"), ("assistant", "b"), ("assistant", "late")]
    digest = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in want).encode()).hexdigest()
    assert (found[1]["n_turns"], found[1]["turns_sha256"], found[1]["loss_chars"]) == (4, digest, 6)
    assert found[1]["loss_sha256"] == hashlib.sha256(b"bblate").hexdigest()
    assert (found[None]["n_turns"], found[2]["loss_chars"]) == (1, 0)
    assert chat.format_conversations(df.filter("false")).count() == 0


def test_chat_query(spark, folder):
    found = {r["conv_id"]: r for r in queries.op2_chat(spark, folder).collect()}
    turns: dict = {}
    for r in spark.read.parquet(f"{folder}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns.setdefault(r["conv_id"], []).append((r["role"], r["text"] or ""))
    turns[-7] = [(role, r"\### Assistant: </turn> ok") for role in ("user", "assistant")]
    assert set(found) == set(turns)
    for key, said in turns.items():
        whole = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest()
        loss = "".join(t for r, t in said if r == "assistant")
        row = found[key]
        assert (row["n_turns"], row["turns_sha256"]) == (len(said), whole)
        assert (row["loss_chars"], row["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert row["formatted_chars"] == len(chat.turn_template(said))

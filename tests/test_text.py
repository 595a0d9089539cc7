import html
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from codequarry import fixed_values as V
from codequarry.limits import SERVICE_LIMITS
from codequarry.functions import identity, paths, text, urls

PIECES = st.sampled_from([
    "api_key = \"abcdefgh\"", "API-KEY: x", "token=éééééééé", "password:'12345678'", "secret", "sk-" + "a" * 20,
    "sk-" + "a" * 19, "ghp_" + "Z9" * 18, "AKIA" + "A1B2C3D4E5F6G7H8", "jailbreak", "JailBreak",
    "you are now", "You  are now", "ignore previous instructions", "system prompt", "jailjailbreakbreak",
    "```", "<b>&amp;</b>", " ", "\u001c", "　", "\n", " ", "credential = 'aaaaaaaaa",
    "ſecret=12345678", "é", "𝄞", "́", "²²²²²²²²", "key",
])
TEXTS = st.lists(st.one_of(PIECES, st.text(max_size=8).filter(lambda s: "\0" not in s)), max_size=8).map("".join)
BATCHES = st.lists(TEXTS, min_size=20, max_size=60)
FEW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def applied(spark, values, make, kind="string"):
    values = [v.encode("utf-8", "ignore").decode() if isinstance(v, str) else v for v in values]
    df = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}").coalesce(1)
    out = df.select("i", make(F.col("x")).alias("y")).orderBy("i").collect()
    return values, [r.y for r in out]


# Independent models of the rules, in plain Python.
MODEL_RULES = [
    (r"(?i)(api[_-]?key|secret|password|token|credential)\s*[:=]\s*['\"]?[\w-]{8,}", "[REDACTED_SECRET]"),
    (r"sk-[a-zA-Z0-9]{20,}", "[REDACTED_OPENAI_KEY]"),
    (r"ghp_[a-zA-Z0-9]{36}", "[REDACTED_GITHUB_TOKEN]"),
    (r"AKIA[0-9A-Z]{16}", "[REDACTED_AWS_KEY]"),
]


def model_redact(s):
    for pattern, label in MODEL_RULES:
        s = re.sub(pattern, label, s)
    return s


def model_question(s):
    s = s.strip()[:2000]
    for marker in V.INSTRUCTION_MARKERS:
        s = re.compile(re.escape(marker), re.I).sub("", s)
    return s.strip()


def model_answer(context, question):
    found = [p.strip() for p in context.split("```")]
    found = [p for p in found if p][:4]
    out = ["**Question:** " + question + "\n",
           "**Retrieved context (set GEMINI_API_KEY for AI-generated answers):**\n"]
    return "\n".join(out + [f"{n + 1}. {p[:400]}...\n" for n, p in enumerate(found)])


@FEW
@given(BATCHES)
def test_redaction(spark, values):
    values, got = applied(spark, values, text.redact_secrets)
    assert got == [model_redact(v) for v in values]


@FEW
@given(BATCHES)
def test_questions(spark, values):
    values, got = applied(spark, values, lambda c: text.clean_question(c, 2000))
    assert got == [model_question(v) for v in values]


@FEW
@given(BATCHES)
def test_output_and_answer(spark, values):
    values, got = applied(spark, values, text.safe_output)
    assert got == [html.escape(model_redact(v), quote=False) for v in values]
    values, got = applied(spark, values, lambda c: text.offline_answer(c, F.lit("why")))
    assert got == [model_answer(v, "why") for v in values]


def test_question_edges(spark):
    long = "a" * 2001
    values, got = applied(spark, [long, " \u001c hi 　", "jailbreak", "jailjailbreakbreak", ""],
                          lambda c: text.clean_question(c, 2000))
    assert got == ["a" * 2000, "hi", "", "jailbreak", ""]
    _, ok = applied(spark, ["a" * 2000, long, "", None], lambda c: text.valid_question(c, 2000))
    assert ok == [True, False, False, False]


def test_wrap(spark):
    _, got = applied(spark, ["x SYSTEM prompt password=12345678"], text.wrap_untrusted)
    assert got[0].split("\n")[2] == "x [filtered] [REDACTED_SECRET]"
    assert got[0].startswith("<untrusted_repository_data>\n")


def test_labels(spark):
    _, got = applied(spark, ["a b-c" + "d" * 40], text.diagram_label)
    assert got == ["a_b_c" + "d" * 25]
    _, got = applied(spark, [" GitHub.com ,, www.github.com,github.com"], text.setting_values)
    assert got == [["github.com", "www.github.com"]]


URLS = {
    "https://github.com/a/b": None,
    "http://www.github.com/a/b.git": None,
    "https://GitHub.com/a/b/": None,
    "  https://github.com/a/b/tree/main?x=1#y ": None,
    "ssh://github.com/a/b": "scheme",
    "git@github.com:a/b": "scheme",
    "https://example.com/a/b": "host",
    "https://github.com.evil.org/a/b": "host",
    "https://user:pw@github.com:443/a/b": None,
    "https://github.com/a": "parts",
    "https://github.com/a/.git": "parts",
    "https://github.com//": "parts",
    "https://github.com/a/..x": "unsafe",
    "https://github.com/.x/b": "unsafe",
    "https://github.com/a/b..c": "unsafe",
    "": "scheme",
}


def test_url_rules(spark):
    _, got = applied(spark, list(URLS), urls.reject_reason)
    assert dict(zip(URLS, got)) == URLS
    _, got = applied(spark, ["https://github.com/own/name.git/", "https://github.com/own"], urls.repository_name)
    assert got == ["own/name", None] or got == ["own/name.git", None]
    _, got = applied(spark, [" https://github.com/a/b// "], urls.normalised)
    assert got == ["https://github.com/a/b"]


def test_ids(spark):
    import hashlib

    _, got = applied(spark, ["https://github.com/a/b"], identity.repository_id)
    assert got == [hashlib.sha256(b"https://github.com/a/b").hexdigest()[:12]]
    _, got = applied(spark, ["abcdef012345", "ABCDEF012345", "abc", None], identity.valid_repository_id)
    assert got == [True, False, False, False]
    _, got = applied(spark, [None, " main ", "a b", "x" * 129, "f/é", ""], identity.valid_branch)
    assert got == [True, True, False, False, False, False]


PATHS = {
    "a/b.py": (None, ".py", "b"), "build/x.py": (None, ".py", "x"),
    "migrations/versions/1.py": (None, ".py", "1"),
    "app/migrations/versions/1.py": ("generated", ".py", "1"),
    "x_generated.py": ("generated", ".py", "x_generated"), "X_GENERATED.PY": ("generated", ".PY", "X_GENERATED"),
    "poetry.lock": ("generated", ".lock", "poetry"), "d/go.sum": ("generated", ".sum", "go"),
    "Go.sum": (None, ".sum", "Go"), "a..b.py": ("unsafe path", ".py", "a..b"),
    "/abs.py": ("unsafe path", ".py", "abs"), ".hidden/x.py": (None, ".py", "x"), ".x.py": (None, ".py", ".x"),
    ".py": (None, "", ".py"), "a/__init__.py": (None, ".py", "__init__"), "a/Makefile": (None, "", "Makefile"),
}


def test_paths(spark):
    _, reasons = applied(spark, list(PATHS), lambda c: paths.skip_reason(c, F.lit(5), None))
    _, endings = applied(spark, list(PATHS), paths.suffix)
    _, stems = applied(spark, list(PATHS), paths.stem)
    assert dict(zip(PATHS, zip(reasons, endings, stems))) == PATHS
    _, ignored = applied(spark, ["build/x.py", "a/venv/b/x.py", "builds/x.py", "dist"], paths.in_ignored_directory)
    assert ignored == [True, True, False, True]


def test_binary(spark):
    header = b"x" * 8191
    cases = [
        (b"", False), (b"a", False), (b"\0", True), (b"\0" + b"a" * 99, False), (b"\0" + b"a" * 98, True),
        (b"\xff", True), (header + "é".encode(), True), (header + b"a\xff", False), (b"\xef\xbb\xbfx = 1", False),
    ]
    _, got = applied(spark, [c for c, _ in cases], lambda c: paths.is_binary(c, 8192), "binary")
    assert got == [want for _, want in cases]
    _, got = applied(spark, [c for c, _ in cases], lambda c: paths.is_binary(c, 8192, False), "binary")
    assert got == [want if i != 6 else False for i, (_, want) in enumerate(cases)]
    # By default the whole file counts: a cut character is none, a bad byte anywhere is one.
    _, got = applied(spark, [c for c, _ in cases], paths.is_binary, "binary")
    assert got == [{6: False, 7: True}.get(i, want) for i, (_, want) in enumerate(cases)]
    lengths = [0, 1, 524288, 524289]
    _, sizes = applied(spark, lengths, lambda c: paths.skip_reason(F.lit("a.py"), c, None, SERVICE_LIMITS), "int")
    assert sizes == ["empty", None, None, "too large"]
    _, sizes = applied(spark, lengths, lambda c: paths.skip_reason(F.lit("a.py"), c, None), "int")
    assert sizes == ["empty", None, None, None]
    _, cleaned = applied(spark, [b"a\xffb\xc3"], paths.text_of, "binary")
    assert cleaned == [b"a\xffb\xc3".decode("utf-8", "replace")]


def test_patterns_run_only_where_they_can_match(spark):
    """A key that is no api key and what redaction has left behind start no pattern; all that matches is replaced."""
    import random

    from codequarry import fixed_values as V

    plain = ["def main(key={'a': 1}):", "password [REDACTED_SECRET]\nx = 1"[9:], "[REDACTED_SECRET]: [REDACTED_SECRET]="]
    likely = ["API-KEY = 'abcdefgh1'", "[REDACTED_SECRET]token:abcdefgh1", "apıkey=abcdefgh1", "ſecret:abcdefgh1"]
    rows = spark.createDataFrame([(x,) for x in plain + likely], "c string")
    assert [r[0] for r in rows.select(text._may_match(F.col("c"))[0]).collect()] == [False] * 3 + [True] * 4
    rng = random.Random(5)
    bits = ["api", "key", "_", "-", "=", ":", " ", "\n", "'", "pass", "word", "password", "secret", "sec", "ret", "tok", "en",
            "[REDACTED_SECRET]", "[redacted_secret]", "[", "]", "abcdefgh", "abcd", "KEY", "ı", "ſ", "K", "İ", "ey", "cret"]
    some = lambda most: "".join(rng.choices(bits, k=rng.randint(0, most)))
    words = ["api_key", "aPi-kEy", "APIKEY", "secret", "password", "token", "credential"]
    texts = [some(6) + rng.choice(words) * rng.randint(0, 1) + some(1) + rng.choice("=: ") + some(6) for _ in range(4000)]
    every = F.col("c")
    for pattern, by in V.SECRET_RULES:
        every = F.regexp_replace(every, pattern, by)
    many = spark.createDataFrame([(x,) for x in texts], "c string").select("c", text.redact_secrets("c").alias("got"), every.alias("all"))
    assert many.filter("got <> all").collect() == []
    assert many.filter("got <> c").count() > 100

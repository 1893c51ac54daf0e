"""Property tests: generated inputs, many cases per Spark job, brute-force
or legacy-engine oracles."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.functions import lenient_int
from quire.operators import latest_per_key

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

numberish = st.text(alphabet=list("0123456789+-. \t\n,eE x"), max_size=14)


@SETTINGS
@given(values=st.lists(numberish, min_size=20, max_size=120))
def test_lenient_int_is_the_legacy_cast(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    old = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", "false")
        legacy = [r[0] for r in df.select(F.col("x").cast("int")).collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
    ours = [r[0] for r in df.select(lenient_int("x")).collect()]
    assert [(v, a, b) for v, a, b in zip(values, legacy, ours) if a != b] == []


rows_strategy = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 3),
              st.one_of(st.none(), st.text(alphabet="xyz", max_size=3))),
    min_size=1, max_size=80)


def _rank(v):
    # Spark orders NULL below every value
    return (0,) if v is None else (1, v)


@SETTINGS
@given(rows=rows_strategy)
def test_latest_per_key_is_the_brute_force_maximum(spark, rows):
    df = spark.createDataFrame(rows, "k string, seq int, v string")
    got = {r.k: (r.seq, r.v) for r in latest_per_key(df, ["k"], order=["seq"]).collect()}
    want = {}
    for k, seq, v in rows:
        if k is None:
            continue
        if k not in want or (seq, _rank(v)) > (want[k][0], _rank(want[k][1])):
            want[k] = (seq, v)
    assert got == want


def _two(lo, hi):
    return st.integers(lo, hi).map(lambda n: f"{n:02d}")


_time = st.one_of(
    st.just(""), _two(0, 25),
    st.builds(lambda h, m: f"{h}:{m}", _two(0, 24), _two(0, 61)),
    st.builds(lambda h, m, s: f"{h}:{m}:{s}", _two(0, 23), _two(0, 59), _two(0, 60)),
    st.builds(lambda h, m: f"{h}{m}", _two(0, 23), _two(0, 59)),
    st.builds(lambda h, m, s: f"{h}{m}{s}", _two(0, 23), _two(0, 59), _two(0, 60)))
_frac = st.sampled_from(["", "", ".", ",", ".5", ",25", ".123456", ".1234567", ".5.", "..", ".1a",
                         "x", ":", "xy", "+"])
_offset = st.sampled_from(["", "", "Z", "+00:00", "-05:30", "+0200", "+02", "+24:00", "+05:30:15",
                           "+02:00.", "+0200.5", "+02.5", "+02:0030", "Z5"])

stamp_strategy = st.builds(
    lambda y, mo, d, sep, time, frac, off, junk: f"{y}-{mo}-{d}{sep}{time}{frac}{off}{junk}",
    st.integers(0, 9999).map(lambda n: f"{n:04d}"), _two(0, 13), _two(0, 32),
    st.sampled_from(["", "T", " ", "x", "t"]), _time, _frac, _offset,
    st.sampled_from(["", "", "", " ", "x"]))


@SETTINGS
@given(stamps=st.lists(stamp_strategy, min_size=20, max_size=120))
def test_minute_key_is_pythons_rule(spark, stamps):
    import datetime as dt

    from quire.functions import minute_key
    now = "2025-01-01T12:34:56+00:00"

    def py_key(v):
        try:
            return dt.datetime.fromisoformat(v).strftime("%d_%m_%Y_%H_%M")
        except ValueError:
            return dt.datetime.fromisoformat(now).strftime("%d_%m_%Y_%H_%M")

    df = spark.createDataFrame([(v,) for v in stamps], "x string")
    got = [r[0] for r in df.select(minute_key("x", now)).collect()]
    assert [(v, k) for v, k in zip(stamps, got) if k != py_key(v)] == []


_scalar = st.one_of(st.none(), st.booleans(), st.integers(-99, 99),
                    st.text(alphabet="abc xyz_", max_size=6))
_maybe = st.one_of(st.just("<missing>"), _scalar)


def _obj(**fields):
    return {k: v for k, v in fields.items() if v != "<missing>"}


_performer = st.one_of(st.just("<missing>"), st.none(), st.integers(0, 9),
                       st.builds(lambda u, b: _obj(user_id=u, user_is_bot=b), _maybe, _maybe))
_meta = st.one_of(st.just("<missing>"), st.none(), st.builds(lambda d: _obj(domain=d), _maybe))
_event = st.builds(lambda t, p, m: _obj(page_title=t, performer=p, meta=m), _maybe, _performer, _meta)


@SETTINGS
@given(events=st.lists(st.one_of(_event, st.just("<broken>"), st.just("<comment>"), st.just("<array>")),
                       min_size=10, max_size=80))
def test_event_lines_follow_the_generator(spark, events):
    import json

    from quire.operators import sse_to_messages
    now = "2025-01-01T00:00:00+00:00"
    lines = []
    for e in events:
        if e == "<broken>":
            lines.append("data: {broken")
        elif e == "<comment>":
            lines.append(": keep-alive")
        elif e == "<array>":
            lines.append("data: [1, 2]")
        else:
            lines.append("data: " + json.dumps(e))

    def dict_or_empty(x):
        return x if isinstance(x, dict) else {}

    want = []
    for line in lines:  # the generator's per-line rules, plus our documented decisions
        if not line or not line.startswith("data:"):
            continue
        try:
            ev = json.loads(line[len("data:"):].strip())
        except json.JSONDecodeError:
            continue
        if not isinstance(ev, dict):
            continue  # decision: non-object payloads are skipped
        perf, meta = dict_or_empty(ev.get("performer", {})), dict_or_empty(ev.get("meta", {}))
        uid = perf.get("user_id", "")
        uid = "" if uid is None else str(uid)  # decision: JSON null -> ""
        bot = perf.get("user_is_bot", False)
        bot = bot if isinstance(bot, bool) else None  # decision: non-boolean flag -> NULL
        want.append((uid, bot, meta.get("domain", ""), ev.get("page_title", "")))

    def text(v):  # the message fields are text: JSON scalars as their text
        if v is None or isinstance(v, str):
            return v
        return "true" if v is True else "false" if v is False else str(v)

    want = [(u, b, text(d), text(t)) for u, b, d, t in want]
    df = spark.createDataFrame([(ln,) for ln in lines], "value string")
    got = [tuple(r)[:4] for r in sse_to_messages(df, now=now).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


_tweet_field = st.one_of(st.just("<missing>"), st.none(), st.booleans(), st.integers(-99, 99),
                         st.text(alphabet='ab ,"\n', max_size=5))
_tweet_stamp = st.one_of(st.just("<missing>"), st.none(), stamp_strategy, st.just("not-a-date"))
_tweet = st.builds(lambda a, c, t: _obj(author_id=a, created_at=c, text=t),
                   _tweet_field, _tweet_stamp, _tweet_field)


@SETTINGS
@given(msgs=st.lists(st.one_of(_tweet, st.just("<broken>"), st.just("<array>"), st.just("<blank>")),
                     min_size=10, max_size=80))
def test_archive_follows_the_consumer(spark, msgs):
    import datetime as dt
    import json

    from quire.operators import archive_rows
    now = "2025-01-01T12:34:56+00:00"
    values = []
    for m in msgs:
        values.append({"<broken>": "{broken", "<array>": "[1]", "<blank>": ""}.get(m)
                      if isinstance(m, str) else json.dumps(m))

    def minute(created_at):
        try:
            return dt.datetime.fromisoformat(created_at).strftime("%d_%m_%Y_%H_%M")
        except (ValueError, TypeError):  # decision: a non-text stamp also takes "now"
            return dt.datetime.fromisoformat(now).strftime("%d_%m_%Y_%H_%M")

    def cell(x):  # what csv.writer writes for a value
        return "" if x is None else str(x)

    want = []
    for raw in values:  # the consumer's per-message rules
        try:
            tweet = json.loads(raw)
        except json.JSONDecodeError:
            continue  # decision: the consumer would stop here; we skip
        if not isinstance(tweet, dict):
            continue
        a, c, t = tweet.get("author_id", ""), tweet.get("created_at", ""), tweet.get("text", "")
        want.append((cell(a), cell(c), cell(t), minute(c if c is not None else "")))

    df = spark.createDataFrame([(v,) for v in values], "value string")
    got = [tuple(r) for r in archive_rows(df, now).select("author_id", "created_at", "text", "minute")
           .collect()]
    assert sorted(got) == sorted(want)

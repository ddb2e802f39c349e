import random
import re

from folioscope.llm.secret_scan import FEATURES, MIN_LENGTH, candidates, described, dictionary, fit, scan, scored
from folioscope.llm.stages import stage

VALUE = re.compile(r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{%d,}={0,2}" % MIN_LENGTH)


def found_in(text):
    return [(k, p, v) for k, w in enumerate(re.split("[ \t-\r]+", text or "")) for p, v in enumerate(VALUE.findall(w))]


def hexed(rng, n=40):
    return "".join(rng.choice("0123456789abcdef") for _ in range(n))


def corpus(seed, n=240):
    rng = random.Random(seed)
    plain = "plain words stand around everything that is written here today".split()
    rows, truth = [], {}
    for i in range(n):
        kind = rng.choice(["secret", "number", "path", "none", "commit"])
        value = {"secret": f'{rng.choice(["token", "password", "api_key"])} = "{hexed(rng)}"', "number": str(rng.randrange(10**15, 10**16)),
                 "path": f"https://example.org/plain/words-stand/{rng.randrange(10**6)}.html", "none": "", "commit": f"commit {hexed(rng)}"}[kind]
        rows.append((i, " ".join([*rng.choices(plain, k=12), value, *rng.choices(plain, k=5)])))
        truth[i] = kind == "secret"
    return rows, truth


def test_candidates_are_all_found(documents):
    rows = corpus(1)[0] + [(900, None), (901, ""), (902, "x" * 50000 + " a1" + "b" * 20), (903, "n=0123456789abcdef0123,y=ABCDEFGHIJKLMNOP1"), (None, hexed(random.Random(1))),
                           (904, "0123456789abcdef== short1")]
    rows += [rows[0]] * 2
    got = sorted(((r.doc_id, r.position, r.part, r.value) for r in candidates(documents(rows)).collect()), key=repr)
    assert got == sorted(((i, *f) for i, t in rows for f in found_in(t)), key=repr)


def test_features_by_hand(documents):
    rows = [(i, "plain words") for i in range(20)] + [(50, 'secret token = "abcdef0123456789ABCD" next'), (51, "see /var/plain/words/0123456789.txt now")]
    docs = documents(rows)
    got = {r.doc_id: r for r in described(candidates(docs), stage(dictionary(docs, share=0.5), "d")).collect()}
    a, b = got[50], got[51]
    assert (a.length, a.digit_share, a.upper_share, a.named, a.assigned, a.quoted, a.in_path) == (20, 0.5, 0.2, 1, 1, 1, 0)
    assert a.class_changes == 2 / 20 and a.distinct_share == 1.0 and a.dictionary_cover == 0
    assert (b.in_path, b.file_ending, b.named) == (1, 1, 0)
    assert b.dictionary_cover == 10 / len("/var/plain/words/0123456789") and b.usual_pairs == 8 / 10


def test_held_out_findings(documents, spark):
    rows, truth = corpus(2)
    findings = spark.createDataFrame([(i, *f[:2], int(truth[i])) for i, t in rows if i % 2 for f in found_in(t)], "doc_id long, position int, part int, label int")
    got = [r for r in scan(documents(rows), findings).collect() if r.doc_id % 2 == 0]
    assert len(got) == sum(len(found_in(t)) for i, t in rows if i % 2 == 0)
    assert sum(r.is_secret == truth[r.doc_id] for r in got) / len(got) >= 0.95


def test_scan_without_findings(documents):
    rows, truth = corpus(3)
    got = scan(documents(rows)).collect()
    assert all(r.is_secret for r in got if truth[r.doc_id])
    assert not any(r.is_secret for r in got if rows[r.doc_id][1].find("https") >= 0)


def test_one_class_and_empty(documents):
    docs = documents([(1, "1234567890123456 only numbers")])
    rows = described(candidates(docs), stage(dictionary(docs), "d"))
    assert fit(rows.selectExpr("*", "0.0D AS label")) is None
    assert [(r.score, r.is_secret) for r in scored(rows, None).collect()] == [(None, None)]
    assert scan(documents([])).collect() == []
    assert len(FEATURES) == len(set(FEATURES))


def test_values_given_to_a_secret_are_found_whatever_they_look_like(documents):
    texts = {
        'password=hunter2': ["hunter2"], 'Password: p.a$s!': ["p.a$s!"], 'see "api_key": "x", then': ["x"], "db_password := 'two words'": ["two"],
        'authToken="a.b!c@d"': ["a.b!c@d"], "pwd = `q`;": ["q"], "secret\n=\n\tzz": ["zz"], "/login?token=ab&password=cd,ef": ["ab", "cd,ef"],
        "PRIVATE-KEY=>v1": ["v1"], "token ==": [], "monkey: banana": [], "author: someone": [], "a password is short": [], "password": [], "key:": [],
        "token=" + "y" * 30000: ["y" * 30000], "key: é漢": ["é漢"], "secret=v.": ["v"], "password=a password=a": ["a", "a"],
    }
    rows = list(enumerate(texts)) + [(None, "password=n"), (90, None), (91, ""), (92, "   ")]
    got = sorted(((r.doc_id, r.position, r.part, r.value) for r in candidates(documents(rows)).filter("given").collect()), key=repr)
    flat = {}
    for i, _, _, value in sorted(got, key=lambda r: (r[0] is None, r[0], r[1], r[2])):
        flat.setdefault(i, []).append(value)
    assert flat == {**{i: v for i, v in enumerate(texts.values()) if v}, None: ["n"]}


def test_a_run_inside_a_given_value_is_not_a_second_candidate(documents):
    run = "0123456789abcdef0123"
    got = candidates(documents([(1, f"token=a.{run}!"), (2, f"x={run}")])).collect()
    assert sorted((r.doc_id, r.value, r.given) for r in got) == [(1, f"a.{run}!", True), (2, run, False)]


def varied(seed, n=600):
    """Secrets short and long, quoted or not, with any signs, beside numbers, paths, checksums and harmless settings."""
    rng = random.Random(seed)
    plain = "plain words stand around everything that is written here today with some other ones".split()
    signs = "abcdefghjkmnpqrstuvwxyzABCDEFGHJKMNPQRSTUVWXYZ23456789.!$@%"
    rows, truth = [], {}
    for i in range(n):
        name = rng.choice(["token", "password", "api_key", "DB_PASSWORD", "clientSecret"])
        odd = "".join(rng.choice(signs) for _ in range(rng.randrange(8, 15)))
        value, secret = rng.choice([
            (f'{name} = "{hexed(rng)}"', True), (f"{name}={odd}", True), (f"{name}: '{odd}'", True), (f"{name}={hexed(rng, 20)}", True),
            (f"{name}: {rng.choice(plain)}", False), (f"{name}={rng.choice(plain)}", False), (f"commit {hexed(rng)}", False),
            (str(rng.randrange(10**15, 10**16)), False), (f"https://example.org/plain/words-stand/{rng.randrange(10**6)}.html", False)])
        rows.append((i, " ".join([*rng.choices(plain, k=12), value, *rng.choices(plain, k=5)])))
        truth[i] = secret
    return rows, truth


def test_held_out_precision_and_recall(documents, spark):
    rows, truth = varied(5)
    every = [(r.doc_id, r.position, r.part) for r in candidates(documents(rows)).collect()]
    assert {i for i, _, _ in every} >= {i for i, t in truth.items() if t}  # nothing is lost before the forest
    findings = spark.createDataFrame([(*c, int(truth[c[0]])) for c in every if c[0] % 2], "doc_id long, position int, part int, label int")
    got = [r for r in scan(documents(rows), findings).collect() if r.doc_id % 2 == 0]
    hits = sum(r.is_secret and truth[r.doc_id] for r in got)
    precision, recall = hits / sum(r.is_secret for r in got), hits / sum(truth[i] for i in truth if i % 2 == 0)
    print("findings", precision, recall)
    assert precision >= 0.97 and recall >= 0.97
    alone = scan(documents(rows)).collect()
    hits = sum(r.is_secret and truth[r.doc_id] for r in alone)
    precision, recall = hits / sum(r.is_secret for r in alone), hits / sum(truth.values())
    print("without findings", precision, recall)
    assert precision >= 0.9 and recall >= 0.9

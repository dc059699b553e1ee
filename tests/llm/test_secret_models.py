"""The Markov models on secrets and identifiers of other origins than those they are trained on."""

import base64
import importlib
import os
import random
import string
import sysconfig
import uuid

import pytest

from edgelens.llm import secret_scan
from edgelens.llm.secret_scan import LEAST_RATIO, base_spans, scan_secrets, train

ORDINARY = [
    "usr/local/lib/python3/dist-packages/numpy_core2", "kubernetes-deployment-controller-7d4b9c8f6d", "utm_source=newsletter2024_campaign",
    "iPhone15ProMaxCaseWithMagSafe2024", "backup_2024-05-06T07-08-09_full", "2024-11-03_18-22-45_report_final2",
]


def secrets(n, seed=5):
    rng = random.Random(seed)
    kinds = (
        lambda: base64.b64encode(rng.randbytes(rng.randrange(18, 40))).decode().rstrip("="),
        lambda: base64.urlsafe_b64encode(rng.randbytes(24)).decode().rstrip("="),
        lambda: "sk-" + "".join(rng.choices(string.ascii_letters + string.digits, k=40)),
        lambda: base64.b32encode(rng.randbytes(20)).decode(),
    )
    return [kinds[i % len(kinds)]() for i in range(n)]


def identifiers():
    """Names in modules and paths of installed packages that training does not read."""
    found = [f"{m}/{name}" for m in ("poplib", "imaplib", "turtle", "smtplib", "ftplib", "pickletools", "difflib") for name in dir(importlib.import_module(m))]
    for root, _, files in os.walk(sysconfig.get_paths()["purelib"]):
        found += [os.path.join(root, f).rsplit(".", 1)[0] for f in files]
        if len(found) > 5000:
            break
    rng = random.Random(6)
    return found + [str(uuid.UUID(int=rng.getrandbits(128))) for _ in range(200)] + ORDINARY


def judged(models, strings):
    runs = [r for x in strings for r in secret_scan._RUN.findall(x) if any(map(str.isdigit, r)) and any(map(str.isalpha, r))]
    return runs, [models(r) >= LEAST_RATIO for r in runs]


@pytest.fixture(scope="module")
def models(spark):
    return train(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


def test_precision_and_recall_on_strings_of_other_origin(models):
    runs, secret = judged(models, secrets(800))
    recall = sum(secret) / len(runs)
    ordinary, wrong = judged(models, identifiers())
    false = sum(wrong) / len(ordinary)
    assert recall >= 0.9
    assert recall / (recall + false) >= 0.9  # as many of either kind
    assert not any(judged(models, ORDINARY)[1])


def test_models_of_an_empty_table(spark):
    models = train(spark.createDataFrame([], "doc_id long, text string"))
    assert sum(judged(models, secrets(200))[1]) >= 180
    assert not any(judged(models, ORDINARY)[1])


def test_planted_secrets_are_found_where_they_are(spark, models):
    rows, expected = [], {}
    for i, secret in enumerate(x for x in secrets(120, seed=9) if any(map(str.isdigit, x))):
        path = ORDINARY[i % len(ORDINARY)]
        text = f"é see {path} then {secret}, and password = abcdefghijkl{i} with {secret[::-1]} done"
        rows.append((i, text, "x"))
        base = base_spans(text)
        spans = [(a, b, secret_scan.KINDS[k]) for a, k, b in base]
        for run in (secret, secret[::-1]):
            at = text.index(run)
            if not any(a < at + len(run) and at < b for a, b, _ in spans):
                spans.append((at, at + len(run), "markov"))
        expected[i] = sorted(spans)
    found = scan_secrets(spark.createDataFrame(rows, "doc_id long, text string, found string"), models).collect()
    got = {r.doc_id: sorted((s.start, s.end, s.kind) for s in r.found) for r in found}
    same = sum(got[i] == expected[i] for i in expected)
    assert same >= 0.9 * len(expected)
    assert all(not any(s[2] == "markov" and ORDINARY[i % len(ORDINARY)][:6] in rows[i][1][s[0] : s[1]] for s in got[i]) for i in got)

"""Markov spans: a listed set of names and drawn strings, and a plain scoring of every run."""

from __future__ import annotations

import itertools
import math
import random
import re
import string
import uuid

import numpy as np
import pytest

from costloom.llm import secrets as op
from tests.llm.test_llm import EDGE, docs_frame

NAMES = """XMLHttpRequestUpload /usr/local/lib/python3/dist-packages org/apache/hadoop/mapreduce/Job MAX_CONNECTION_POOL_SIZE
AbstractSingletonProxyFactoryBean getElementsByTagName addEventListener-capture SimpleDateFormatSymbols ConcurrentHashMapIterator
java/util/concurrent/atomic/AtomicInteger /etc/systemd/system/multi-user /home/ubuntu/projects/website/static/css
node_modules/webpack/lib/optimize DEFAULT_SOCKET_TIMEOUT_MS SPRING_DATASOURCE_USERNAME kubernetes-dashboard-metrics-scraper
com/google/common/collect/ImmutableList dangerouslySetInnerHTML UIApplicationDelegate NSMutableAttributedString HTTP_X_FORWARDED_FOR
WebSecurityConfigurerAdapter application/vnd/openxmlformats src/main/java/resources/application ENABLE_EXPERIMENTAL_FEATURES
createAsyncThunkMiddleware useLayoutEffectOnceMounted BufferedInputStreamReader content-security-policy-report-only
access-control-allow-origin /var/log/nginx/access __init_subclass_hook__ test_user_can_not_login_twice unordered_multimap_iterator
std_vector_push_back_impl IllegalArgumentException NoSuchBeanDefinitionException document-getElementById jquery-ui-datepicker-trigger
LC_IDENTIFICATION /opt/homebrew/Cellar/openssl XMLSchemaInstanceNamespace ---------------- ================ ________________________
aaaaaaaaaaaaaaaaaaaa ABCDEFGHIJKLMNOPQRSTUVWXYZ abcdefghijklmnopqrstuvwxyz 0123456789012345 2024-01-15-2024-02-15 4716951196110259
AWS_SECRET_ACCESS_KEY_FILE /proc/sys/net/ipv4/ip_forward getDerivedStateFromProps componentWillUnmount OrganizationalUnitPolicy
io/netty/handler/codec/http2/Http2FrameCodec ReentrantReadWriteLock CompletableFutureSupplier /dev/disk/by-uuid/partition
GL_TEXTURE_CUBE_MAP_POSITIVE_X ERR_SSL_VERSION_OR_CIPHER_MISMATCH max-age=31536000/immutable pthread_mutexattr_settype
SQLIntegrityConstraintViolation PyUnicode_AsUTF8String torch/nn/modules/transformer google-cloud-storage-transfer
Microsoft/EntityFrameworkCore/SqlServer android/permission/ACCESS_FINE_LOCATION ExponentialBackoffRetryPolicy
X-Content-Type-Options stratified_shuffle_split HyperparameterOptimizer distributedDataParallel serviceAccountTokenCreator
EXTERNAL_CONTENT_URI_AUTHORITY""".split()


@pytest.fixture(scope="module")
def model(spark):
    docs = op.documents(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    return op.train(op.count_samples(docs))


def spans(text, model):
    return op.markov_spans(text, op.base_spans(text), model)


def test_names_paths_constants_and_uuids_are_left_alone(model):
    rng = random.Random(11)
    listed = NAMES + [str(uuid.UUID(int=rng.getrandbits(128))) for _ in range(20)] + ["request-id=" + str(uuid.UUID(int=rng.getrandbits(128))).upper() for _ in range(5)]
    hit = [x for x in listed if spans(f"see {x} there", model)]
    assert len(hit) <= len(listed) / 100, hit


@pytest.mark.parametrize("n", [16, 20, 24, 32])
@pytest.mark.parametrize("alphabet", [string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/", string.ascii_letters,
                                      string.ascii_uppercase + string.digits, string.ascii_lowercase + string.digits])
def test_drawn_strings_are_found(model, n, alphabet):
    rng = random.Random(n)
    drawn = ["".join(rng.choices(alphabet, k=n)) for _ in range(300)]
    assert sum(bool(spans(f"so {x} it is", model)) for x in drawn) >= 270


def test_the_margin_follows_the_length(model):
    wide = op.RatioModel(model.ratio, -1.0, 1.6, op.ScanParams())
    assert wide.margin(16) > wide.margin(20) > wide.margin(24) >= wide.margin(1000) == op.ScanParams().least_margin
    assert wide.margin(16) == -1.0 + 4.5 * 1.6 / math.sqrt(15)


def test_markov_spans_equal_a_plain_scoring(spark, model):
    rng = random.Random(3)
    kinds = [lambda: rng.choice(NAMES), lambda: "".join(rng.choices(op.ALPHABET, k=rng.randrange(10, 50))), lambda: "token=" + "x" * rng.randrange(4, 9),
             lambda: "AKIA" + "".join(rng.choices(string.ascii_uppercase, k=rng.choice([10, 16, 20]))), lambda: "deadbeef" * rng.randrange(1, 5), lambda: str(uuid.UUID(int=rng.getrandbits(128)))]
    texts = [rng.choice([" ", "/", ", é "]).join(rng.choice(kinds)() for _ in range(rng.randrange(1, 9))) for _ in range(300)]
    found = 0
    for t in texts:
        taken = [(a, z) for a, z, _ in op.base_spans(t)]
        for m in re.finditer(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}", t):
            if not (t[m.start() - 1:m.start()].isascii() and t[m.start() - 1:m.start()].isalnum()) and not (t[m.end():m.end() + 1].isascii() and t[m.end():m.end() + 1].isalnum()):
                taken.append(m.span())
        free = "".join("\0" if any(a <= i < z for a, z in taken) else c for i, c in enumerate(t))
        want = []
        for is_run, group in itertools.groupby(enumerate(free), lambda x: x[1] in op.ALPHABET):
            group = list(group)
            if is_run and len(group) >= 16:
                piece = "".join(c for _, c in group)
                ratio = sum(model.ratio[op.ALPHABET.index(x), op.ALPHABET.index(y)] for x, y in zip(piece, piece[1:])) / (len(piece) - 1)
                if ratio > max(0.35, model.mean + 4.5 * model.deviation / math.sqrt(len(piece) - 1)):
                    want.append((group[0][0], group[-1][0] + 1, "markov"))
        # a run shorter than 16 characters as a whole is not looked at
        assert spans(t, model) == want
        found += len(want)
    assert found > 100
    got = {r["doc_id"]: r["spans"] for r in op.scan(docs_frame(spark, list(enumerate(texts)) + EDGE)).collect() if r["doc_id"] is not None}
    assert len(got) >= len(texts)


def test_models_without_a_corpus(spark):
    counts = op.count_samples(op.documents(docs_frame(spark, [])))
    assert counts.sum() == 0
    model = op.train(counts)
    assert np.isfinite(model.ratio).all() and not spans("AbstractSingletonProxyFactoryBean", model)

"""Secrets in texts: candidates by pattern, false positives removed by a random forest."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import log, log2

import numpy as np
import pyarrow as pa
import regex
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.staging import stage
from . import common

#: Runs of characters that keys and tokens are made of, and the name that a run may begin with.
RUN = regex.compile(r"(?<![A-Za-z0-9+/_=.\-])[A-Za-z0-9+/_=.\-]{12,}")
LEADING_NAME = regex.compile(r"-{0,2}[A-Za-z_][A-Za-z0-9_.\-]*=+(?=[^=])")
#: A run without a digit is a candidate from this many letters on, of so many kinds, or where a capital follows a small letter.
LONG, DIFFERENT = 20, 6
CAMEL = regex.compile(r"[a-z][^A-Z]*[A-Z]")
#: Values assigned to a credential's name count from this length on.
SHORT = 4
NAME = (r"(?:token|secret|passw(?:or)?d|passphrase|pwd|api[ _-]?key|access[ _-]?key|private[ _-]?key|secret[ _-]?key|credential)"
        r"s?[0-9]*")
#: What stands between name and value; the same text as a Java regular expression in ``label_findings``.
ASSIGN = r"\\?[\"'`]?\s*(?::=|=>|={1,3}|:)\s*"
_ON_LINE = ASSIGN.replace(r"\s", r"[^\S\r\n]")
#: A value in quotes ends at the same quote, another one at white space, a quote or the next ``name=``.
ASSIGNED = regex.compile(
    rf"{NAME}{_ON_LINE}(?!{NAME}{_ON_LINE}\S)" r"""(?:(?P<quote>\\?["'`])(?P<in>(?:(?!(?P=quote))[^\r\n])+)(?P=quote)"""
    r"""|\\?["'`]?(?P<bare>(?:(?![&,;]\w+=)[^\s"'`])+))""", regex.IGNORECASE)
# Published forms of keys, values that stand in for one, and words that such values are made of.
PUBLISHED = (r"^((AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|npm_[A-Za-z0-9]{36}|glpat-[A-Za-z0-9_\-]{20}|hf_[A-Za-z]{34}|"
             r"xox[abprs]-[0-9A-Za-z\-]{10,}|[sr]k_live_[0-9A-Za-z]{16,}|AIza[0-9A-Za-z_\-]{35}|"
             r"eyJ[A-Za-z0-9_\-]{8,}\.eyJ[A-Za-z0-9_\-]{8,}\.[A-Za-z0-9_\-]+|SG\.[A-Za-z0-9_\-]{22}\.[A-Za-z0-9_\-]{43})$")
STAND_IN = (r"(?i)^([<\[{(].*|\$.*|%.*|.*\(.*\).*|x+|\*+|\.+|-+|null|none|nil|undefined|true|false|todo|tbd|empty|change[_-]?me|redacted|"
            r"(my|your|test|dummy|fake|example|placeholder|sample|default|insert)[_ -].*|.*(example|placeholder|here|goes here)|"
            r"(os|process|env|config|settings|self|this)\..*|password|passwd|secret|token|test|dummy|foobar)$")
STAND_INS = ["changeme", "change_me", "null", "none", "undefined", "<YOUR_NAME>", "<NAME>", "${NAME}", "$NAME", "%NAME%", "{{ NAME }}", "xxxxxxxx",
             "xxxxxxxxxxxxxxxx", "********", "your-api-key-here", "your_token", "my-secret", "example", "placeholder", "REDACTED",
             "os.environ['NAME']", "process.env.NAME", "config.secret", "get_secret()", "TODO", "password", "secret", "test", "dummy"]
STAND_IN_WORDS = ["your", "token", "here", "change", "changeme", "null", "none", "undefined", "example", "password", "secret", "key", "api", "redacted",
                  "test", "todo", "dummy", "placeholder", "environ", "process", "config", "sample", "default", "name"]
#: Kinds of characters, for transitions: lower, upper, digit, other.
KINDS = 4
REACH = 48
FEATURES = ["length", "letters", "digits", "entropy", "hex", "changes", *[f"from{a}to{b}" for a in range(KINDS) for b in range(KINDS)],
            "surprise", "coverage", "path", "before", "before2", "after", "quoted", "assigned"]


def _kind(c: str) -> int:
    return 2 if c.isdigit() else 0 if c.islower() else 1 if c.isupper() else 3


def _assigned(text: str) -> Iterator[tuple[int, int, int]]:
    """(start, end, where the name starts) of values assigned to a credential's name."""
    if "=" in text or ":" in text:
        for m in ASSIGNED.finditer(text):
            kind = "in" if m["in"] is not None else "bare"
            start, end = m.span(kind)
            if kind == "bare":
                end = start + len(m[kind].rstrip(",;.)]}>\\"))
            if end - start >= SHORT:
                yield start, end, m.start()


def _run_counts(run: str) -> bool:
    return any(map(str.isdigit, run)) or bool(CAMEL.search(run)) or (
        len(run) >= LONG and sum(map(str.isalpha, run)) >= LONG and len(set(filter(str.isalpha, run))) >= DIFFERENT)


def candidates(text: str | None) -> Iterator[tuple[int, str, str, str]]:
    """(start, candidate, what stands before it, what after) over the whole text, by start.

    Candidates are the values assigned to a credential's name, four characters or more of any kind, and runs of 12 or
    more of [A-Za-z0-9+/_=.-] with a digit, 20 letters of six kinds or a capital after a small letter.  A name that a run begins with
    (``name=``) is no part of the candidate but stands before it.  A run within an assigned value is not told again.
    """
    text = text or ""
    found = {start: (end, name) for start, end, name in _assigned(text)}
    values, at = sorted((start, end) for start, (end, _) in found.items()), 0
    for m in RUN.finditer(text):
        if not _run_counts(m[0]):
            continue
        start, end = m.span()
        if name := LEADING_NAME.match(m[0]):
            start += name.end()
        while at < len(values) and values[at][1] <= start:
            at += 1
        if at < len(values):  # the value may end before dots that the run has with it
            last = start + len(text[start:end].rstrip("."))
            inside = values[at][0] <= start and last <= values[at][1]
        else:
            inside = False
        if end - start >= SHORT and not inside:
            found.setdefault(start, (end, start))
    for start, (end, name) in sorted(found.items()):
        yield start, text[start:end], text[max(0, min(name, start - REACH)):start], text[end:end + REACH]


def find_candidates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """(doc_id, path, start, candidate, before, after) of every candidate in whole texts; a null text has none."""
    rows = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{path_col}`").cast("string").alias("path"),
                     F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, path string, start bigint, candidate string, before string, after string"
    names = ["doc_id", "path", "start", "candidate", "before", "after"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(i, *c) for i, text in enumerate(batch.column("text")) for c in candidates(text.as_py())]
            at = pa.array([f[0] for f in found], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(at), batch.column("path").take(at), pa.array([f[1] for f in found], pa.int64()),
                 *[pa.array([f[k] for f in found], pa.string()) for k in (2, 3, 4)]], names)

    return rows.mapInArrow(run, schema)


def words_around(before: str, after: str) -> tuple[str, str, str]:
    """The two words before a candidate and the one after, lower-cased, letters only."""
    left, right = regex.findall(r"\p{L}+", before.lower()), regex.findall(r"\p{L}+", after.lower())
    return (left[-1] if left else "", left[-2] if len(left) > 1 else "", right[0] if right else "")


class Knowledge:
    """What the features look up: dictionary, letter transitions, and how often a path or neighbour marks a secret.

    All come from the labelled findings and the dictionary; ``share`` smooths towards the overall rate.
    """

    def __init__(self, words: list[str], findings: list[tuple[bool, str, str, str]]):
        self.words = {w for w in words if len(w) >= 3}
        self.longest = max(map(len, self.words), default=0)
        self.steps, self.stays = Counter(), Counter()
        for w in words:
            for a, b in zip(w, w[1:]):
                self.steps[a + b] += 1
                self.stays[a] += 1
        self.rate = (sum(f[0] for f in findings) + 0.5) / (len(findings) + 1)
        self.seen, self.secret = Counter(), Counter()
        for label, path, before, after in findings:
            for key in {("path", path), *(("word", w) for w in words_around(before, after))}:
                self.seen[key] += 1
                self.secret[key] += label

    def share(self, kind: str, value: str | None) -> float:
        return (self.secret[kind, value] + 5 * self.rate) / (self.seen[kind, value] + 5)

    def coverage(self, text: str) -> float:
        """Share of the characters that dictionary words cover, longest words first from the left."""
        low, at, covered = text.lower(), 0, 0
        while at < len(low):
            n = next((n for n in range(min(self.longest, len(low) - at), 2, -1) if low[at:at + n] in self.words), 0)
            covered += n
            at += n or 1
        return covered / len(low)

    def surprise(self, text: str) -> float:
        """Mean negative log2 probability of a letter after the one before it, as in the dictionary."""
        low = text.lower()
        steps = [-log2((self.steps[low[i:i + 2]] + 0.1) / (self.stays[low[i]] + 4)) for i in range(len(low) - 1)]
        return sum(steps) / max(1, len(steps))

    def features(self, path: str | None, candidate: str, before: str, after: str) -> list[float]:
        n, counts = len(candidate), Counter(candidate)
        kinds = [_kind(c) for c in candidate]
        moves = np.zeros((KINDS, KINDS))
        np.add.at(moves, (kinds[:-1], kinds[1:]), 1.0 / max(1, n - 1))
        w1, w2, w3 = words_around(before, after)
        return [float(n), sum(k < 2 for k in kinds) / n, kinds.count(2) / n,
                -sum(c / n * log(c / n) for c in counts.values()), sum(c in "0123456789abcdefABCDEF" for c in candidate) / n,
                sum(a != b for a, b in zip(kinds, kinds[1:])) / n, *moves.ravel().tolist(), self.surprise(candidate),
                self.coverage(candidate), self.share("path", path), self.share("word", w1), self.share("word", w2),
                self.share("word", w3), float(before.endswith(("\"", "'", "`")) and after.startswith(("\"", "'", "`"))),
                float(bool(regex.search(r"[=:]\s*[\"'`]?$", before)))]


def dictionary(df: DataFrame, text_col: str = "text", size: int = 5000) -> list[str]:
    """The ``size`` most frequent words of letters over all texts, lower-cased; ties by the word."""
    words = df.select(F.explode(F.split(F.lower(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))), r"[^\p{L}]+")).alias("w"))
    top = words.where("length(w) >= 3").groupBy("w").count().orderBy(F.col("count").desc(), "w").limit(size)
    return [r["w"] for r in top.collect()]


def _featured(found: DataFrame, shared) -> DataFrame:
    names = found.columns
    schema = f"{found.schema.simpleString()[7:-1].replace(':', ' ')}, features array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            rows = zip(*[batch.column(c).to_pylist() for c in ("path", "candidate", "before", "after")])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([known.features(*r) for r in rows], pa.list_(pa.float64()))],
                                             [*names, "features"])

    return found.mapInArrow(run, schema)


def train(labelled: DataFrame, words: list[str], sample: int = 20_000, trees: int = 30, depth: int = 8, seed: int = 42,
          each: int = 0, without: str | None = None):
    """(knowledge, forest) from labelled findings (path, candidate, before, after, label); a bounded sample of them.

    ``sample`` bounds the findings used; they are chosen by a hash of the finding.  ``each`` findings of every published form
    are made and taught as well, less the form ``without`` (see ``made_findings``).  If the sampled rows have one label only there is
    no forest: (None, None).
    """
    spark = labelled.sparkSession
    made = None
    if each:
        others = labelled.where(~F.col("label")).select("before", "after").orderBy(F.xxhash64(F.lit(seed), "before", "after")).limit(500)
        rows = made_findings([(r["before"], r["after"]) for r in others.collect()], each, seed, without)
        made = spark.createDataFrame([r[1:] for r in rows], "path string, candidate string, before string, after string, label boolean")
    counts = {r["label"]: r["count"] for r in labelled.where("label is not null").groupBy("label").count().collect()}
    if len(counts) < 2 and not (made and counts):
        return None, None
    share = min(1.0, sample / sum(counts.values()))
    rare = min(1.0, sample / 2 / min(counts.values()))
    place = F.pmod(F.xxhash64(F.lit(seed), "candidate", "before", "after"), F.lit(1 << 40)) / float(1 << 40)
    few = min(counts, key=counts.get)
    taken = labelled.where(F.when(F.col("label") == few, place < rare).otherwise(place < share)).select(
        "path", "candidate", "before", "after", "label")
    some = stage(taken.unionByName(made) if made else taken, "labelled-findings")
    if some.select("label").distinct().count() < 2:
        return None, None
    rows = some.select("label", "path", "before", "after").limit(2 * sample).collect()
    known = Knowledge([*words, *STAND_IN_WORDS], [(r["label"], r["path"], r["before"], r["after"]) for r in rows])
    shared = spark.sparkContext.broadcast(known)
    fit = _featured(some, shared).select(array_to_vector("features").alias("v"), F.col("label").cast("double").alias("y"))
    forest = RandomForestClassifier(featuresCol="v", labelCol="y", numTrees=trees, maxDepth=depth, seed=seed).fit(
        stage(fit, "forest-rows"))
    return shared, forest


def scan(df: DataFrame, knowledge, forest: RandomForestClassificationModel | None, id_col: str = "doc_id",
         text_col: str = "text", path_col: str = "source", least: float = 0.5) -> DataFrame:
    """(doc_id, path, start, candidate, score, is_secret) of every candidate in whole texts.

    score is the forest's probability; ``is_secret`` from ``least`` on.  Without a forest every candidate is kept, with
    score 1.  Null and empty texts have no findings; repeated rows give their findings each; other columns are not read.
    """
    found = find_candidates(df, id_col, text_col, path_col)
    if forest is None:
        return found.select("doc_id", "path", "start", "candidate", F.lit(1.0).alias("score"), F.lit(True).alias("is_secret"))
    forest.setProbabilityCol("p").setFeaturesCol("v").setRawPredictionCol("raw").setPredictionCol("guess")
    scored = forest.transform(_featured(found, knowledge).withColumn("v", array_to_vector("features")))
    score = F.element_at(vector_to_array("p"), 2)
    return scored.select("doc_id", "path", "start", "candidate", score.alias("score"), (score >= least).alias("is_secret"))


def label_findings(found: DataFrame) -> DataFrame:
    """Labels for findings where nobody has labelled any.

    Secrets are keys of a published form, wherever they stand, and values assigned to a credential's name, unless they stand in
    for one: a placeholder, a variable or a call.
    """
    assigned = F.lower("before").rlike(NAME + ASSIGN + r"\\?[\"'`]?$")
    return found.withColumn("label", F.col("candidate").rlike(PUBLISHED) | (assigned & ~F.col("candidate").rlike(STAND_IN)))


def _text_of(rng: np.random.Generator, letters: str, n: int) -> str:
    return "".join(rng.choice(list(letters), n))


def made_findings(contexts: list[tuple[str, str]], each: int = 200, seed: int = 42, without: str | None = None) -> list[tuple]:
    """(form, path, candidate, before, after, label): ``each`` findings of every form, in contexts that do not tell.

    Keys are drawn by their published formats and stand, like digests and identifiers, where other candidates of the
    corpus stand; stand-ins stand where secrets do.  ``without`` leaves out one form, to see whether the others teach it.
    """
    rng = np.random.default_rng(seed)
    upper, lower, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
    every, base = upper + lower + digits, upper + lower + digits + "+/"
    hexes = digits + "abcdef"
    text = lambda letters, n: _text_of(rng, letters, n)
    keys = {
        "cloud key": lambda: rng.choice(["AKIA", "ASIA"]) + text(upper + digits, 16),
        "repository token": lambda: rng.choice(["ghp_", "gho_", "ghs_", "npm_"]) + text(every, 36),
        "project token": lambda: "glpat-" + text(every, 20), "model token": lambda: "hf_" + text(upper + lower, 34),
        "chat token": lambda: f"xoxb-{text(digits, 11)}-{text(digits, 12)}-{text(every, 24)}",
        "payment key": lambda: rng.choice(["sk_live_", "rk_live_"]) + text(every, 24),
        "maps key": lambda: "AIza" + text(every + "_-", 35),
        "signed token": lambda: f"eyJ{text(every, 30)}.eyJ{text(every, 60)}.{text(every + '_-', 43)}",
        "mail key": lambda: f"SG.{text(every, 22)}.{text(every + '_-', 43)}", "private key line": lambda: text(base, 64),
        "access key": lambda: text(base, 40)}
    others = {
        "digest": lambda: text(hexes, int(rng.choice([32, 40, 64]))),
        "identifier": lambda: "-".join(text(hexes, n) for n in (8, 4, 4, 4, 12)),
        "number": lambda: text(digits, int(rng.integers(12, 20))),
        "name": lambda: "".join(text(lower, int(rng.integers(3, 8))).title() for _ in range(4)),
        "path": lambda: "/".join(text(lower, int(rng.integers(3, 9))) for _ in range(4)) + f".v{rng.integers(9)}",
        "date": lambda: f"20{text(digits, 2)}-0{rng.integers(1, 9)}-1{rng.integers(9)}T12.{text(digits, 2)}"}
    out = []
    for label, forms in ((True, keys), (False, others)):
        for form, draw in forms.items():
            for _ in range(each if form != without else 0):
                before, after = contexts[int(rng.integers(len(contexts)))] if contexts else ("", "")
                out.append((form, None, str(draw()), before, after, label))
    for _ in range(each if without != "stand-in" else 0):
        name, word = rng.choice(["password", "api_key", "secret", "token"]), str(rng.choice(STAND_INS))
        quote = rng.choice(["", '"', "'"])
        out.append(("stand-in", None, word.replace("NAME", str(name).upper()), f"{name} {rng.choice([':', '='])} {quote}", quote, False))
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All findings in documents: doc_id, start, length, the finding's SHA-256 (never itself), score, is_secret, held_out."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    teaching = docs.where(common.crc_bucket("doc_id", 4) != 2)
    labelled = stage(label_findings(find_candidates(teaching)), "findings")
    found = scan(docs, *train(labelled, dictionary(docs), each=200))
    return found.select("doc_id", "start", F.length("candidate").cast("long").alias("length"),
                        F.sha2("candidate", 256).alias("finding_sha256"), "score", "is_secret",
                        (common.crc_bucket("doc_id", 4) == 2).alias("held_out"))

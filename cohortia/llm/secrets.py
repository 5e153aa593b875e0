"""Secrets in texts: candidates by shape, false positives removed by a random forest.

A candidate is a run of 16 or more letters, digits and ``+/=_-`` that has a digit, a key
with a provider's prefix, the body of a private key, the password of a URL, or a shorter
value assigned to a credential name.  Keys, bodies and URL passwords that are no samples
are secrets by their shape alone; a corpus may have too few to learn them from.  The
forest judges it by its length, its character transitions, how much of it words of a
dictionary cover, the path it was found under and the neighbouring words.  Forest and
features are DataFrame expressions: trees grow level by level from counts of (tree,
node, feature, bin), and a grown tree is a CASE expression.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortia.llm.common import stage

NAMES = r"(?i:token|secret|passw(?:or)?d|passwd|pwd|api[_-]?key|access[_-]?key|private[_-]?key|credential)"
PROVIDER = (
    r"(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{20,}+|github_pat_[A-Za-z0-9_]{22,}+"
    r"|xox[abeprs]-[A-Za-z0-9\-]{10,}+|[srp]k_(?:live|test)_[A-Za-z0-9]{16,}+|sk-[A-Za-z0-9_\-]{20,}+"
    r"|AIza[A-Za-z0-9_\-]{35}|glpat-[A-Za-z0-9_\-]{20,}+|npm_[A-Za-z0-9]{36}"
    r"|eyJ[A-Za-z0-9_\-]{8,}+\.eyJ[A-Za-z0-9_\-]{8,}+\.[A-Za-z0-9_\-]{8,}+)"
)
KEY_BEGINS, URL_USER = r"PRIVATE KEY(?: BLOCK)?-----", r"://[^\s:/@\"'<>]{0,255}:"
_GAP = r"(?:\s|\\[rn])"
KEY_BODY = (  # headers, lines, and a last line that may be short; possessive loops need no stack
    rf"(?<=-----)(?<={KEY_BEGINS}){_GAP}*+(?:[A-Za-z]++(?:-[A-Za-z]++)?+:[^\n]*+\s++)*+"
    rf"[A-Za-z0-9+/=]{{16,}}+(?:{_GAP}++[A-Za-z0-9+/=]{{16,}}+)*+"
    rf"(?:{_GAP}++[A-Za-z0-9+/=]++(?={_GAP}*+-----END))?+"
)
RUN = (  # not where a credential name and its sign of assignment begin
    rf"(?<![A-Za-z0-9+/=_\-])(?![A-Za-z0-9_\-]{{0,32}}{NAMES}[A-Za-z0-9_\-]{{0,16}}=[^=\s])"
    r"(?=[A-Za-z+/=_\-]{0,64}[0-9])[A-Za-z0-9+/=_\-]{16,}+"
)
ASSIGNED = (  # in quotes, or with a digit, a mark or mixed case
    rf"(?<=[:=]\s{{0,2}}[\"']?)(?<={NAMES}[A-Za-z0-9_\-]{{0,16}}[\"']?\s{{0,2}}[:=]{{1,2}}\s{{0,2}}[\"']?)"
    r"(?:(?<=[\"'])[^\s\"'<>]{6,}+(?=[\"'])"
    r"|(?<![\"'])(?=[^\s\"'<>,;()\[\]{}]{0,64}[0-9!@#$%^&*]|[A-Za-z+/_\-]{0,32}[a-z][A-Z])[^\s\"'<>,;()\[\]{}]{6,}+)"
)
CANDIDATE = "|".join((
    KEY_BODY, rf"(?<=:)(?<={URL_USER})[^\s/@\"'<>]++(?=@)", ASSIGNED,
    rf"(?<![A-Za-z0-9+/=_\-]){PROVIDER}(?![A-Za-z0-9+/=_\-])", RUN,
))
OPEN, CLOSE = "﷐", "﷑"  # noncharacters that mark candidates
MASK = "[SECRET]"
AROUND = 48  # characters of context on either side

#: Words that name credentials, paths that hold samples, words of samples.
KEY_WORDS = r"(?i)(token|secret|passw(or)?d|passwd|pwd|api[_-]?key|access[_-]?key|auth|bearer|credential|private[_-]?key)"
SAMPLE_PATHS = r"(?i)(test|example|sample|fixture|mock|doc)"
SAMPLE_WORDS = r"(?i)(example|sample|dummy|placeholder|changeme|your|xxx|todo|fake)"

FEATURES = (
    "length", "digits", "capitals", "hexadecimal", "distinct", "transitions", "covered",
    "key_word", "assigned", "quoted", "sample_word", "address", "path_sample", "path_depth",
    "certain",
)

TREES, DEPTH, BINS = 16, 5, 16
SPLIT_FEATURES = 5  # features that a node may split on
LEARN_ROWS = 20_000  # about as many labelled findings are learnt from
DICTIONARY = 1_000  # words of the dictionary
LEAST = 0.5  # score of a secret


def dictionary(docs: DataFrame, *, words: int = DICTIONARY) -> list[str]:
    """The words (4 letters or more) that most texts of ``docs`` hold, ties by word.

    Every text counts; counts combine map-side, and only ``words`` words reach the driver.
    """
    own = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}{4,}+"), F.lit(0)))
    found = (
        # the outer form: the plain one lets the optimizer match once more, to drop empty arrays
        docs.select(F.explode_outer(own).alias("word")).filter("word IS NOT NULL")
        .groupBy("word").count().orderBy(F.desc("count"), "word").limit(words)
    )
    return sorted(row["word"] for row in found.collect())


def _each(found: DataFrame, *keep: str) -> DataFrame:
    """One row per candidate: ``keep``, nth and f.

    The outer form of the explode: for the plain one the optimizer adds a filter on the
    array's size and moves it before all others, which finds the candidates of all texts
    twice, also of those that are not wanted.
    """
    return found.select(*keep, F.posexplode_outer("llm_found").alias("nth", "f")).filter("f IS NOT NULL")


def _features(candidate: Column, before: Column, after: Column, path: Column,
              words: list[str]) -> list[Column]:
    n = F.length(candidate).cast("double")
    known = F.array(*[F.lit(word) for word in words]) if words else F.array().cast("array<string>")
    runs = F.regexp_extract_all(F.lower(candidate), F.lit(r"\p{L}{4,}+"), F.lit(0))
    covered = F.aggregate(
        runs, F.lit(0), lambda sum_, run: sum_ + F.when(
            F.array_contains(known, run), F.length(run)).otherwise(0))
    steps = F.regexp_count(candidate, F.lit(
        r"(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Za-z])|(?<=[0-9])(?=[^0-9])|(?<=[A-Z])(?=[a-z][^a-z])"))
    near = F.substring(before, -24, 24)
    name = F.regexp_extract(before, r"([A-Za-z0-9_.\-]*)[\"']?\s*[:=]+\s*[\"']?$", 1)
    sample = F.concat(name, F.lit(" "), candidate).rlike(SAMPLE_WORDS)
    certain = (
        candidate.rlike(f"^{PROVIDER}$") | before.rlike(KEY_BEGINS + "$")
        | (before.rlike(URL_USER + "$") & after.rlike("^@")))
    count = lambda pattern: F.regexp_count(candidate, F.lit(pattern)).cast("double")
    yes = lambda test: F.coalesce(test.cast("double"), F.lit(0.0))
    return [
        n,
        count("[0-9]") / n,
        count("[A-Z]") / n,
        yes(candidate.rlike("^([0-9a-f]+|[0-9A-F]+)$")),
        F.size(F.array_distinct(F.split(candidate, ""))).cast("double") / F.least(n, F.lit(64.0)),
        steps.cast("double") / n,
        covered.cast("double") / n,
        yes(near.rlike(KEY_WORDS)),
        yes(before.rlike(r"[:=]\s*[\"']?$")),
        yes(before.rlike(r"[\"'`]$") & after.rlike(r"^[\"'`]")),
        yes(sample),
        yes(before.rlike(r"[@/.]$") | after.rlike(r"^[@.][A-Za-z]")),
        yes(path.rlike(SAMPLE_PATHS)),
        F.coalesce(F.regexp_count(path, F.lit("/")).cast("double"), F.lit(0.0)),
        yes(certain & ~sample),
    ]


def candidates(docs: DataFrame, words: list[str], *, path: str = "source") -> DataFrame:
    """``docs`` with columns llm_parts and llm_found.

    llm_parts is the text cut before each candidate (null if there is none); llm_found
    has candidate, context and features ``x`` of each, in order.
    """
    marked = F.regexp_replace(
        F.regexp_replace("text", f"[{OPEN}{CLOSE}]", " "), CANDIDATE, f"{OPEN}$0{CLOSE}")
    parts = docs.withColumn(
        "llm_parts", F.when(F.col("text").rlike(CANDIDATE), F.split(marked, OPEN)))
    place = F.col(f"`{path}`").cast("string") if path in docs.columns else F.lit(None).cast("string")

    def found(i: Column) -> Column:
        part, last = F.element_at("llm_parts", i), F.element_at("llm_parts", i - 1)
        text = F.substring_index(part, CLOSE, 1)
        before = F.regexp_replace(F.substring(last, -AROUND, AROUND), CLOSE, "")
        after = part.substr(F.length(text) + 2, F.lit(AROUND))
        return F.struct(text.alias("candidate"), before.alias("before"), after.alias("after"))

    spans = parts.withColumn("llm_found", F.when(
        F.col("llm_parts").isNotNull(),
        F.transform(F.expr("sequence(2, size(llm_parts))"), found)))
    return spans.withColumn("llm_found", F.transform("llm_found", lambda c: F.struct(
        c["candidate"].alias("candidate"), c["before"].alias("before"),
        F.array(*_features(c["candidate"], c["before"], c["after"], place, words)).alias("x"))))


@dataclass
class Forest:
    """Trees as nested (feature, cut, low, high); a leaf is the share of label 1."""

    trees: list = field(default_factory=list)

    def score(self, x: Column) -> Column:
        """Mean over the trees; 0.5 without trees."""
        def value(node) -> Column:  # noqa: ANN001
            if isinstance(node, float):
                return F.lit(node)
            feature, cut, low, high = node
            return F.when(x[feature] <= cut, value(low)).otherwise(value(high))

        if not self.trees:
            return F.lit(0.5)
        return sum((value(tree) for tree in self.trees[1:]), value(self.trees[0])) / len(self.trees)


def grow(findings: DataFrame) -> Forest:
    """A forest from labelled findings (x: array of features, label 0 or 1).

    Rows without label are left out.  Cuts are quantiles; rows that fall between the same
    cuts are one row with a weight, and a tree draws how often it takes each of them.
    Only counts of (tree, node, feature, bin) reach the driver.
    """
    rows = findings.filter(F.col("label").isin(0, 1)).select("x", "label")
    m = len(FEATURES)
    shares = F.array(*[F.lit(i / BINS) for i in range(1, BINS)])
    # features are mostly one of a few values, so the cuts are quantiles and their middles
    quantiles = rows.agg(*[
        F.percentile_approx(F.col("x")[i], shares, 1000).alias(f"c{i}") for i in range(m)
    ], *[F.min(F.col("x")[i]).alias(f"l{i}") for i in range(m)],
        *[F.max(F.col("x")[i]).alias(f"h{i}") for i in range(m)]).first()
    cuts = []
    for i in range(m):
        values = sorted({quantiles[f"l{i}"], quantiles[f"h{i}"], *(quantiles[f"c{i}"] or [])} - {None})
        cuts.append([(a + b) / 2 for a, b in zip(values, values[1:])])
    bins = F.array(*[
        sum((F.when(F.col("x")[i] > cut, 1).otherwise(0) for cut in cuts[i]), F.lit(0))
        for i in range(m)
    ])
    binned = rows.groupBy(bins.alias("b")).agg(
        F.sum("label").alias("ones"), F.count("*").alias("n"))
    drawn = stage(
        binned.withColumn("tree", F.explode(F.array(*[F.lit(t) for t in range(TREES)])))
        # a Poisson draw of mean 1 for each cell and tree, by hash
        .withColumn("u", F.pmod(F.xxhash64("b", "tree"), F.lit(1 << 30)) / float(1 << 30))
        .withColumn("times", sum(
            (F.when(F.col("u") > limit, 1).otherwise(0)
             for limit in (0.367879, 0.735759, 0.919699, 0.981012, 0.99634)), F.lit(0)))
        .filter("times > 0")
        .select("tree", "b", (F.col("ones") * F.col("times")).alias("ones"),
                (F.col("n") * F.col("times")).alias("n"))
    )
    splits: dict[tuple[int, int], tuple[int, int]] = {}
    leaves: dict[tuple[int, int], float] = {}
    open_ = {(t, 1) for t in range(TREES)}
    for depth in range(DEPTH + 1):
        if not open_:
            break
        counts: dict = {}
        for row in _node_counts(drawn, splits, open_).collect():
            counts.setdefault((row["tree"], row["node"]), {}).setdefault(
                row["feature"], {})[row["bin"]] = (row["ones"], row["n"])
        later = set()
        for node in open_:
            by_feature = counts.get(node, {})
            ones, n = map(sum, zip(*by_feature[0].values())) if by_feature else (0, 0)
            leaves[node] = (ones + 0.5) / (n + 1)
            cut = _best(node, by_feature, ones, n) if depth < DEPTH else None
            if cut:
                splits[node] = cut
                later |= {(node[0], 2 * node[1]), (node[0], 2 * node[1] + 1)}
        open_ = later

    def built(node: tuple[int, int]):  # noqa: ANN202
        if node not in splits:
            return float(leaves[node])
        feature, bin_ = splits[node]
        tree, number = node
        return (feature, cuts[feature][bin_], built((tree, 2 * number)),
                built((tree, 2 * number + 1)))

    return Forest([built((t, 1)) for t in range(TREES)] if counts_any(leaves) else [])


def counts_any(leaves: dict) -> bool:
    """Whether any finding was learnt from: a leaf of none is exactly one half."""
    return any(value != 0.5 for value in leaves.values())


def _node_counts(drawn: DataFrame, splits: dict, open_: set) -> DataFrame:
    """Counts of (tree, node, feature, bin) of the open nodes."""
    def node_of(tree: int, number: int) -> Column:
        if (tree, number) not in splits:
            return F.lit(number)
        feature, bin_ = splits[tree, number]
        return F.when(F.col("b")[feature] <= bin_, node_of(tree, 2 * number)).otherwise(
            node_of(tree, 2 * number + 1))

    node = F.lit(None).cast("int")
    for tree in range(TREES):
        node = F.when(F.col("tree") == tree, node_of(tree, 1)).otherwise(node)
    wanted = F.array(*[F.lit(f"{t}/{n}") for t, n in sorted(open_)])
    return (
        drawn.withColumn("node", node)
        .filter(F.array_contains(wanted, F.concat_ws("/", "tree", "node")))
        .select("tree", "node", F.posexplode("b").alias("feature", "bin"), "ones", "n")
        .groupBy("tree", "node", "feature", "bin")
        .agg(F.sum("ones").alias("ones"), F.sum("n").alias("n"))
    )


def _best(node: tuple[int, int], by_feature: dict, ones: int, n: int) -> tuple[int, int] | None:
    """Feature and last low bin of the cut of least Gini impurity, among drawn features."""
    if n < 4 or ones in (0, n):
        return None
    order = sorted(by_feature, key=lambda f: zlib.crc32(f"{node}/{f}".encode()))
    best = None
    varied = [f for f in order if len(by_feature[f]) > 1]
    for feature in varied[:SPLIT_FEATURES]:
        low_ones = low_n = 0
        for bin_ in sorted(by_feature[feature])[:-1]:
            low_ones += by_feature[feature][bin_][0]
            low_n += by_feature[feature][bin_][1]
            high_ones, high_n = ones - low_ones, n - low_n
            impurity = low_ones * (low_n - low_ones) / low_n + high_ones * (high_n - high_ones) / high_n
            if best is None or impurity < best[0]:
                best = impurity, feature, bin_
    return best[1:] if best and best[0] < ones * (n - ones) / n else None


def labelled(found: DataFrame) -> DataFrame:
    """Label findings by how they stand in their text: what reviewers would mark.

    Label 1: a mixed value assigned to a name of a credential, and keys, bodies of private
    keys and URL passwords (``certain``), but for sample values.  Label 0: digits only,
    words only, sample values, and values that nothing names.
    """
    x = {name: F.col("x")[i] for i, name in enumerate(FEATURES)}
    positive = (
        (x["key_word"] == 1) & (x["assigned"] == 1) & (x["sample_word"] == 0)
        & (x["digits"].between(0.05, 0.95) | (x["digits"] < 0.05) & (x["transitions"] > 0.1))
        & (x["distinct"] > 0.2)
    ) | (x["certain"] == 1)
    return found.withColumn("label", positive.cast("int"))


def learn(docs: DataFrame, words: list[str], *, rows: int = LEARN_ROWS) -> Forest:
    """A forest from the labelled findings of about ``rows`` texts of ``docs``."""
    n = docs.count()
    share = min(1.0, rows / max(n, 1))
    chosen = docs.filter(
        F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 20)) < int(share * (1 << 20))
        if share < 1 else F.lit(True)
    )
    found = _each(candidates(chosen, words)).select("f.x")
    return grow(stage(labelled(found)))


def judged(forest: Forest, x: Column) -> Column:
    """The forest's score; 1 if the shape alone tells."""
    return F.when(x[FEATURES.index("certain")] == 1, 1.0).otherwise(forest.score(x))


def findings(docs: DataFrame, forest: Forest, words: list[str]) -> DataFrame:
    """doc_id, nth (place among the text's candidates), length, sha256, score, is_secret.

    One row per candidate of every whole text; null and empty texts have none.  Repeated
    rows give repeated rows.
    """
    found = _each(candidates(docs.select("doc_id", "text", "source"), words), "doc_id")
    return (
        found.withColumn("score", judged(forest, F.col("f.x")))
        .select(
            "doc_id", F.col("nth").cast("long").alias("nth"),
            F.length("f.candidate").cast("long").alias("length"),
            F.sha2("f.candidate", 256).alias("candidate_sha256"),
            "score", (F.col("score") >= LEAST).alias("is_secret"),
        )
    )


def masked(docs: DataFrame, forest: Forest, words: list[str]) -> DataFrame:
    """``docs`` with every secret of their texts replaced by a mask; all rows stay."""
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    parts = candidates(docs.select(row.alias("row"), "text", "source"), words).withColumn(
        "llm_secret", F.transform("llm_found", lambda c: judged(forest, c["x"]) >= LEAST))

    def shown(i: Column) -> Column:
        part = F.element_at("llm_parts", i)
        secret = (i > 1) & F.element_at("llm_secret", F.greatest(i - 1, F.lit(1)))
        return F.when(secret, F.concat(
            F.lit(MASK), part.substr(F.locate(CLOSE, part) + 1, F.length(part))
        )).otherwise(F.regexp_replace(part, CLOSE, ""))

    text = F.when(
        F.exists("llm_secret", lambda secret: secret),
        F.array_join(F.transform(F.expr("sequence(1, size(llm_parts))"), shown), ""),
    ).otherwise(F.col("text"))
    return parts.withColumn("text", text).select(*[
        F.col("text") if name == "text" else F.col(f"row.`{name}`") for name in docs.columns
    ])

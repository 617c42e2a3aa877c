"""Quality rules: counts of a text, and lines labelled by a linear-chain CRF.

Words are runs of characters other than ASCII white space. ``base_failed``: fewer
than 20 words, or over 30 % of the words lie in 8-word windows that occur twice or
more. Beyond that, the lines that have words are decoded by Viterbi into content
and boilerplate, and a document is kept if content holds at least ``MIN_SHARE`` of
its word characters.

The CRF is trained by gradient descent on at most ``TRAIN_ROWS`` labelled
documents of each quality (those that come first by a hash of doc_id, with at most
``TRAIN_LINES`` lines); lines take the label of their document. Without labels of
both kinds, every line counts as content.

Null text has no words and fails the base rules. Each input row gives one output
row; repeated rows and null ids included. Other columns are not read.
"""


import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from shoplake.llm.common import Hashes, arrow_map, first_by_hash, shingles, table, utf8

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
#: The least share of a document's word characters that content lines must hold.
MIN_SHARE = 0.4
TRAIN_ROWS = 600
TRAIN_LINES = 60
STEPS = 200

_CONTINUATION = bytes(range(0x80, 0xC0))


def counts(text: bytes | None, cache: Hashes) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``."""
    text = text or b""
    words = text.split()
    chars = len(b"".join(words).translate(None, _CONTINUATION))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.strip()]
    windows = shingles(cache.of(words), WINDOW)
    _, which, times = np.unique(windows, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(times[which] > 1) if len(windows) else windows.astype(np.int64)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + WINDOW, -1)
    repeated = int((np.cumsum(edges) > 0).sum())
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEATED_PERCENT * n_words


def features(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """A row of features and the number of word characters for each line with words."""
    rows, sizes, seen = [], [], set()
    for line in (text or b"").split(b"\n"):
        words = line.split()
        if not words:
            continue
        body = line.decode("utf-8", "replace")
        size = max(len(b"".join(words).translate(None, _CONTINUATION)), 1)
        letters = sum(map(str.isalpha, body))
        upper = sum(map(str.isupper, body))
        symbols = len(line) - len(line.translate(None, SYMBOLS))
        marks = len(line) - len(line.translate(None, b"!?"))
        digits = len(line) - len(line.translate(None, b"0123456789"))
        rows.append((
            1.0, letters / size, upper / max(letters, 1), min(1.0, 4 * symbols / size), min(1.0, 8 * marks / size),
            digits / size, float(b" | " in line or line.startswith(b"| ")), float(line.rstrip()[-1:] in b".!?:;\"'"),
            float(len(words) < 4), min(len(words), 40) / 40, min(size / len(words), 20) / 20,
            1 - len(set(words)) / len(words), float(line in seen),
            float(upper > 0.6 * max(letters, 1)), float(12 * symbols > size), float(b"http" in line or b"www." in line),
        ))
        seen.add(line)
        sizes.append(size)
    return np.array(rows, np.float64).reshape(-1, WIDTH), np.array(sizes, np.float64)


WIDTH = 16


def train(texts: list[tuple[bytes, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Weights (2 x features) and transitions (2 x 2; state 1 is content)."""
    weight, move = np.zeros((2, WIDTH)), np.zeros((2, 2))
    chains = [(x, label) for x, label in ((features(t)[0], q) for t, q in texts) if len(x)]
    if len({label for _, label in chains}) < 2:
        weight[1, 0] = 1.0
        return weight, move
    longest = max(len(x) for x, _ in chains)
    inputs = np.zeros((len(chains), longest, WIDTH))
    mask = np.zeros((len(chains), longest), bool)
    labels = np.array([label for _, label in chains])
    for n, (x, _) in enumerate(chains):
        inputs[n, :len(x)], mask[n, :len(x)] = x, True
    # either quality weighs the same, and every document as much as any other
    share = np.where(labels == 1, 0.5 / (labels == 1).sum(), 0.5 / (labels == 0).sum()) / mask.sum(1)
    gold = np.stack([labels == 0, labels == 1], 1).astype(float)
    moments = [np.zeros_like(weight), np.zeros_like(weight), np.zeros_like(move), np.zeros_like(move)]
    for step in range(1, STEPS + 1):
        near, pairs = marginals(inputs @ weight.T, move, mask)
        slope = np.einsum("nls,nlf,n->sf", (near - gold[:, None, :]) * mask[:, :, None], inputs, share)
        gold_pairs = np.einsum("ns,nt,n->st", gold, gold, (mask.sum(1) - 1) * share)
        slope_move = np.einsum("nst,n->st", pairs, share) - gold_pairs
        for value, grad, at in ((weight, slope + 1e-3 * weight, 0), (move, slope_move + 1e-3 * move, 2)):
            moments[at] += 0.1 * (grad - moments[at])
            moments[at + 1] += 0.01 * (grad ** 2 - moments[at + 1])
            value -= 0.1 * (moments[at] / (1 - 0.9 ** step)) / (np.sqrt(moments[at + 1] / (1 - 0.99 ** step)) + 1e-9)
    return weight, move


def marginals(scores: np.ndarray, move: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward: probability of each state by line, expected moves by chain."""
    n, longest, _ = scores.shape
    ahead, back = np.zeros_like(scores), np.zeros_like(scores)
    ahead[:, 0] = scores[:, 0]
    for t in range(1, longest):
        ahead[:, t] = scores[:, t] + np.logaddexp.reduce(ahead[:, t - 1][:, :, None] + move, axis=1)
    for t in range(longest - 2, -1, -1):
        step = np.logaddexp.reduce(move + (scores[:, t + 1] + back[:, t + 1])[:, None, :], axis=2)
        back[:, t] = np.where(mask[:, t + 1][:, None], step, 0.0)
    both = ahead + back
    near = np.exp(both - np.logaddexp.reduce(both, axis=2, keepdims=True))
    pairs = np.zeros((n, 2, 2))
    for t in range(1, longest):
        joint = ahead[:, t - 1][:, :, None] + move + (scores[:, t] + back[:, t])[:, None, :]
        joint = np.exp(joint - np.logaddexp.reduce(joint.reshape(n, 4), axis=1)[:, None, None])
        pairs += joint * mask[:, t][:, None, None]
    return near, pairs


def viterbi(scores: np.ndarray, move: np.ndarray) -> np.ndarray:
    """The likeliest states; equal paths prefer content."""
    (m00, m01), (m10, m11) = move.tolist()
    s0 = s1 = 0.0
    came = []
    for n, (a, b) in enumerate(scores.tolist()):
        if n:
            from0, from1 = int(s1 + m10 >= s0 + m00), int(s1 + m11 >= s0 + m01)
            came.append((from0, from1))
            s0, s1 = a + (s1 + m10 if from0 else s0 + m00), b + (s1 + m11 if from1 else s0 + m01)
        else:
            s0, s1 = a, b
    states = [int(s1 >= s0)] if len(scores) else []
    for pair in reversed(came):
        states.append(pair[states[-1]])
    return np.array(states[::-1], np.int64)


def model(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Fit the CRF on the bounded sample of labelled documents."""
    body = F.col(f"`{text}`")
    short = F.length(body) - F.length(F.translate(body, "\n", "")) < TRAIN_LINES
    marks = labels.where(F.col("quality").isin(0, 1)).select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("kind"))
    rows = docs.where(short).select(F.col(f"`{id}`").alias("id"), body.alias("text"))
    return train([(r["text"].encode(), r["kind"]) for r in first_by_hash(rows, TRAIN_ROWS, marks)])


def rules(docs: DataFrame, fitted: tuple[np.ndarray, np.ndarray], id: str = "doc_id", text: str = "text") -> DataFrame:
    """The counts and the verdict of every document, with its share of content.

    ``line_labels`` has 1 for content and 0 for boilerplate, for lines with words.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fitted)
    schema = (
        f"`{id}` bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
        "n_repeat_words bigint, base_failed boolean, kept boolean, content_share double, line_labels array<int>"
    )

    def start():
        (weight, move), cache = shared.value, Hashes()

        def step(ids, texts):
            out = []
            for name, body in zip(ids, texts):
                found = counts(body, cache)
                failed = base_failed(found[0], found[4])
                lines, sizes = features(body)
                states = viterbi(lines @ weight.T, move)
                share = float((sizes * states).sum() / sizes.sum()) if len(sizes) else 0.0
                out.append((name, *found, failed, not failed and share >= MIN_SHARE, share, states.tolist()))
            return out

        return step

    rows = docs.select(F.col(f"`{id}`").cast("bigint").alias("id"), utf8(text).alias("text"))
    return arrow_map(rows, schema, start)


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return rules(docs, model(docs, table(spark, folder, "labels"))).drop("line_labels")

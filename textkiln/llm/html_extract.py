"""Main-text extraction with a tree-structured graphical model (operator 10).

A page's block elements form a tree; each node has a hidden label, content or
not.  Unary potentials are linear in a node's features, pair potentials join a
child to its parent and are linear in the child's edge features.  Sum-product
messages pass upward and downward over all pages of an Arrow batch at once,
level by level, and give every node's exact marginal; the text of the nodes
that are more likely content than not is the page's text, block by block.  The
weights maximise the likelihood of a small table of labelled pages
(``page_labels``); the gradient comes from the same messages.

Edge cases: null or empty html has no text (empty string); unclosed, crossed or
truncated markup is read the way browsers imply ends; text outside any element
belongs to the document node; very long and very deep pages are read whole,
without recursion; repeated rows give the same text each; only id, url and html
are read, so further columns never clash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textkiln.llm.common import slices
from textkiln.llm.html_tree import CUES, FEATURES, TAGS, features, parse

# Edge features: a constant, what the child and what the parent open, and whether the parent is the page itself.
_OPENERS = [FEATURES.index(f"tag_{t}") for t in ("article", "main", "nav", "aside", "header", "footer", "form", "list", "item", "box")]
_OPENERS += [FEATURES.index(f"cue_{c}") for c in CUES]
EDGES = 2 * len(_OPENERS) + 2
_ROOT = FEATURES.index("tag_root")


@dataclass
class Model:
    """``unary``: a weight for each feature in favour of content; ``pair``:
    edge feature by parent's label by child's label."""

    unary: np.ndarray
    pair: np.ndarray


def _edge_features(x: np.ndarray, parent: np.ndarray) -> np.ndarray:
    above = np.where(parent[:, None] >= 0, x[parent], 0.0)
    return np.column_stack([np.ones(len(x)), x[:, _OPENERS], above[:, _OPENERS], above[:, _ROOT]])


def _levels(parent: np.ndarray) -> list[np.ndarray]:
    """Nodes by depth, roots first; parents come before their children."""
    depth = np.zeros(len(parent), np.int64)
    for i, p in enumerate(parent.tolist()):
        if p >= 0:
            depth[i] = depth[p] + 1
    order = np.argsort(depth, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)


def marginals(model: Model, x: np.ndarray, parent: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """P(content) of each node, the joint P(parent's label, own label) of each
    edge, and the log partition function; a forest of many pages at once."""
    n = len(x)
    theta = np.zeros((n, 2))
    theta[:, 1] = x @ model.unary
    psi = np.einsum("ne,eab->nab", _edge_features(x, parent), model.pair)
    levels = _levels(parent)
    inner = theta.copy()  # own potential and all messages from below
    up = np.zeros((n, 2))
    for nodes in levels[:0:-1]:
        joint = psi[nodes] + inner[nodes][:, None, :]
        up[nodes] = np.logaddexp(joint[:, :, 0], joint[:, :, 1])
        np.add.at(inner, parent[nodes], up[nodes])
    belief = inner.copy()
    pairs = np.zeros((n, 2, 2))
    for nodes in levels[1:]:
        p = parent[nodes]
        rest = belief[p] - up[nodes]  # what the parent knows without this child
        joint = psi[nodes] + inner[nodes][:, None, :] + rest[:, :, None]
        belief[nodes] = np.logaddexp(joint[:, 0], joint[:, 1])
        joint -= joint.max(axis=(1, 2), keepdims=True)
        pairs[nodes] = np.exp(joint) / np.exp(joint).sum(axis=(1, 2), keepdims=True)
    root = levels[0]
    log_z = float(np.logaddexp(inner[root, 0], inner[root, 1]).sum())
    return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -700, 700))), pairs, log_z


def _forest(pages: list) -> tuple[np.ndarray, np.ndarray]:
    x = np.array([row for nodes in pages for row in features(nodes)]).reshape(-1, len(FEATURES))
    starts = np.cumsum([0, *map(len, pages)])
    parent = np.concatenate([[n.parent + (s if n.parent >= 0 else 0) for n in nodes] for nodes, s in zip(pages, starts, strict=False)]).astype(np.int64)
    return x, parent


def fit(pages: list[str], steps: int = 400, rate: float = 0.1, penalty: float = 0.001) -> Model:
    """Maximum likelihood with an L2 penalty on labelled pages, whose elements
    carry ``data-label="content"`` or ``"other"``; a label holds for everything
    below, and what has none is ``other``."""
    trees = [parse(p)[0] for p in pages]
    x, parent = _forest(trees)
    marked = [n.label for nodes in trees for n in nodes]
    y = np.zeros(len(x), np.int64)
    for i, p in enumerate(parent.tolist()):
        y[i] = marked[i] == "content" if marked[i] else (y[p] if p >= 0 else 0)
    edges, children = _edge_features(x, parent), np.flatnonzero(parent >= 0)
    seen = np.zeros((len(x), 2, 2))
    seen[children, y[parent[children]], y[children]] = 1.0
    flat = np.zeros(x.shape[1] + EDGES * 4)
    m, v = np.zeros_like(flat), np.zeros_like(flat)
    for t in range(1, steps + 1):
        model = Model(flat[: x.shape[1]], flat[x.shape[1] :].reshape(EDGES, 2, 2))
        p, pairs, _ = marginals(model, x, parent)
        grad = np.concatenate([x.T @ (y - p), np.einsum("ne,nab->eab", edges, seen - pairs).ravel()]) / len(pages) - penalty * flat
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        flat = flat + rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return Model(flat[: x.shape[1]].copy(), flat[x.shape[1] :].reshape(EDGES, 2, 2).copy())


def texts(model: Model, pages: list[str | None]) -> list[str]:
    """Main text of each page: content blocks in page order, a line each."""
    if not pages:
        return []
    parsed = [parse(p) for p in pages]
    x, parent = _forest([nodes for nodes, _ in parsed])
    content = marginals(model, x, parent)[0] > 0.5
    out, start = [], 0
    for nodes, segments in parsed:
        out.append("\n".join(text for owner, text in segments if content[start + owner]))
        start += len(nodes)
    return out


def extract(pages: DataFrame, model: Model, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` (code points) of every row."""
    source = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(page).alias("html"))
    schema = T.StructType([source.schema["page_id"], source.schema["url"], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches):
        for whole in batches:
            for batch in slices(whole, 2, 1 << 20):
                found = texts(model, batch.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())], names=schema.names)

    return source.mapInArrow(run, schema)


__all__ = ["FEATURES", "TAGS", "Model", "extract", "fit", "marginals", "texts"]

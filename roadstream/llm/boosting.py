"""Histogram gradient-boosted trees for two classes, flattened into arrays for vectorised traversal."""

import numpy as np

BINS = 64


class Trees:
    """Trees as arrays over all nodes: feature, threshold, left, right (a leaf points to itself), value."""

    def __init__(self, base: float):
        self.base, self.depth = base, 0
        self.roots: list[int] = []
        self.feature, self.threshold, self.left, self.right, self.value = [], [], [], [], []

    def leaf(self, value: float) -> int:
        place = len(self.value)
        for column, x in ((self.feature, 0), (self.threshold, np.inf), (self.left, place), (self.right, place), (self.value, value)):
            column.append(x)
        return place

    def flat(self) -> "Trees":
        self.feature, self.left, self.right = (np.array(x, np.int64) for x in (self.feature, self.left, self.right))
        self.threshold, self.value = np.array(self.threshold), np.array(self.value)
        return self

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of the second class."""
        total, number = np.full(len(rows), self.base), np.arange(len(rows))
        for root in self.roots:
            node = np.full(len(rows), root)
            for _ in range(self.depth):
                low = rows[number, self.feature[node]] <= self.threshold[node]
                node = np.where(low, self.left[node], self.right[node])
            total += self.value[node]
        return 1 / (1 + np.exp(-total))


def edges_of(rows: np.ndarray) -> list[np.ndarray]:
    """Bin edges of each column, at its quantiles."""
    return [np.unique(np.quantile(x, np.linspace(0, 1, BINS + 1)[1:-1])) for x in rows.T]


def fit(rows: np.ndarray, labels: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, l2: float = 2.0,
        least: float = 2.0) -> Trees:
    """Boost ``trees`` trees on the logistic loss.  least: smallest sum of second derivatives in a leaf."""
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    model = Trees(float(np.log(share / (1 - share))))
    model.depth = depth
    if len(labels) == 0 or labels.min() == labels.max():
        return model.flat()
    edges = edges_of(rows)
    width = rows.shape[1]
    binned = np.stack([np.searchsorted(e, x, side="left") for e, x in zip(edges, rows.T)], axis=1)
    cell = binned + np.arange(width) * BINS
    total = np.full(len(rows), model.base)
    for _ in range(trees):
        chance = 1 / (1 + np.exp(-total))
        slope, curve = labels - chance, chance * (1 - chance)
        root = model.leaf(0.0)
        model.roots.append(root)
        level = [(root, np.arange(len(rows)))]
        for _ in range(depth):
            below = []
            for node, members in level:
                flat = cell[members].ravel()
                g, h = (np.bincount(flat, np.repeat(x[members], width), width * BINS).reshape(width, BINS).cumsum(1)
                        for x in (slope, curve))
                gain = g**2 / (h + l2) + (g[:, -1:] - g) ** 2 / (h[:, -1:] - h + l2) - g[:, -1:] ** 2 / (h[:, -1:] + l2)
                gain[(h < least) | (h[:, -1:] - h < least)] = -np.inf
                column, cut = divmod(int(np.argmax(gain)), BINS)
                if gain[column, cut] <= 1e-6 or cut >= len(edges[column]):
                    continue
                low = binned[members, column] <= cut
                model.feature[node], model.threshold[node] = column, edges[column][cut]
                sides = []
                for part in (members[low], members[~low]):
                    place = model.leaf(float(rate * slope[part].sum() / (curve[part].sum() + l2)))
                    sides.append(place)
                    below.append((place, part))
                    total[part] += model.value[place] - model.value[node]
                model.left[node], model.right[node] = sides
            level = below
    return model.flat()

"""Hand-made rating fixtures (FIXTURES.md section 3)."""

import numpy as np

# tiny: every user averages 3, so deviations are easy to work by hand.
#   u1: i1=5 i2=3 i3=1   devs  1, 0, -1   unit  1/sqrt2, 0, -1/sqrt2
#   u2: i1=4 i2=2        devs  .5, -.5    unit  1/sqrt2, -1/sqrt2
#   u3: i2=5 i3=1 i4=3   devs  1, -1, 0   unit  1/sqrt2, -1/sqrt2, 0
#   u4: i1=2 i4=4        devs -.5, .5     unit -1/sqrt2, 1/sqrt2
# sims: (1,2)=.5 (1,3)=.5 (1,4)=-.5 (2,3)=-.5 (2,4)=-.5 (3,4)=0
TINY = [
    (1, 1, 5), (1, 2, 3), (1, 3, 1),
    (2, 1, 4), (2, 2, 2),
    (3, 2, 5), (3, 3, 1), (3, 4, 3),
    (4, 1, 2), (4, 4, 4),
]
TINY_SIMS = {(1, 2): 0.5, (1, 3): 0.5, (1, 4): -0.5, (2, 3): -0.5, (2, 4): -0.5}

# flat_user: u5 rates everything 4 -> norm 0, no neighbours, never a neighbour.
FLAT = TINY + [(5, 1, 4), (5, 2, 4)]

# ties: u1's two neighbours u2 and u3 have equal similarity.
TIES = [
    (1, 1, 5), (1, 2, 1),
    (2, 1, 5), (2, 2, 1), (2, 3, 3),
    (3, 1, 5), (3, 2, 1), (3, 4, 3),
]


def random_ratings(n_users, n_items, density, seed):
    rng = np.random.default_rng(seed)
    rows = []
    for u in range(n_users):
        items = np.flatnonzero(rng.random(n_items) < density)
        if len(items) < 2:
            items = rng.choice(n_items, 2, replace=False)
        for i in items:
            rows.append((u, int(i), float(rng.integers(1, 6))))
    return rows


def planted(n_groups=3, per_group=12, items_per_group=10, seed=7):
    """Users in taste groups: high ratings for their group's items, low for
    the rest, with a little noise."""
    rng = np.random.default_rng(seed)
    rows = []
    n_items = n_groups * items_per_group
    for g in range(n_groups):
        for m in range(per_group):
            u = g * per_group + m
            for i in range(n_items):
                if rng.random() < 0.6:
                    liked = i // items_per_group == g
                    base = 5 if liked else 1
                    r = min(5, max(1, base + int(rng.integers(-1, 2)) * (rng.random() < 0.3)))
                    rows.append((u, i, float(r)))
    return rows


def dense_reference(rows, k, lo=1.0, hi=5.0):
    """Brute force in numpy: dense deviations, dense cosine matrix, top k
    of the others by (-sim, id), zeros never stored."""
    users = sorted({u for u, _, _ in rows})
    items = sorted({i for _, i, _ in rows})
    ui = {u: a for a, u in enumerate(users)}
    ii = {i: a for a, i in enumerate(items)}
    R = np.zeros((len(users), len(items)))
    M = np.zeros_like(R)
    for u, i, r in rows:
        R[ui[u], ii[i]] = r
        M[ui[u], ii[i]] = 1
    avg = R.sum(1) / M.sum(1)
    A = avg[:, None]
    scale = np.where(R > A, hi - A, np.where(R < A, A - lo, 1.0))
    with np.errstate(divide="ignore", invalid="ignore"):  # unrated cells are masked out
        D = np.where(M > 0, (R - A) / scale, 0.0)
    norm = np.sqrt((D * D).sum(1))
    W = np.divide(D, norm[:, None], out=np.zeros_like(D), where=norm[:, None] > 0)
    S = np.round(W @ W.T, 9)
    n = len(users)
    nbrs = {}
    for a in range(n):
        others = [(-S[a, b], users[b], S[a, b]) for b in range(n) if b != a]
        others.sort()
        nbrs[users[a]] = {(v, round(s, 9)) for _, v, s in others[:k] if s != 0}
    return nbrs, S, users, items, D, M, avg

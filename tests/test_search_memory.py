"""Items meet the queries some at a time, whatever the size of Spark's batches."""

import numpy as np

from wattlake.operators import retrieval


def test_items_of_a_batch_are_searched_in_blocks(monkeypatch):
    import pandas as pd

    rng, sizes, best = np.random.default_rng(1), [], retrieval._best

    def counted(query_ids, query_matrix, item_ids, item_matrix, k):
        sizes.append(len(item_ids))
        return best(query_ids, query_matrix, item_ids, item_matrix, k)

    monkeypatch.setattr(retrieval, "_best", counted)
    items, queries = rng.integers(-2, 3, (3000, 4)).astype(float), rng.normal(size=(3, 4))
    batch = pd.DataFrame({"item_id": np.arange(3000)[::-1], "embedding": list(items)})
    unit = retrieval._unit_rows(pd.Series(list(queries)))
    found = pd.concat(retrieval._search_batches(np.arange(3), unit, 5)(iter([batch])))
    assert max(sizes) <= 512
    scores = np.round(unit @ retrieval._unit_rows(batch["embedding"]).T, 9)
    for q in range(3):
        want = sorted(zip(-scores[q], batch["item_id"]))[:5]
        assert [(-r.score, r.item_id) for r in found[found["query_id"] == q].itertuples()] == want

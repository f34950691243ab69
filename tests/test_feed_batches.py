"""The registered stream applies its feed in several batches, later ones to keys that earlier ones wrote."""

from conftest import SF0001
from tavola import schemas
from tavola.plans.registry import all_queries
from tavola.streaming import ingest


def test_registered_stream_merges_later_batches_into_earlier_state(spark, monkeypatch):
    batches, merge = [], ingest.merge_batch

    def recorded(batch, batch_id, *args, **kw):
        batches.append({tuple(r) for r in batch.select(*schemas.ITEM_KEYS, "op").collect()})
        merge(batch, batch_id, *args, **kw)

    monkeypatch.setattr(ingest, "merge_batch", recorded)
    got = all_queries()["cdc_stream_apply"](spark, SF0001)
    want = all_queries()["cdc_apply"](spark, SF0001)
    assert len(batches) == 4 and all(batches)
    earlier, ops = set(), set()
    for batch in batches:
        ops |= {op for *key, op in batch if tuple(key) in earlier}
        earlier |= {tuple(key) for *key, _ in batch}
    assert ops == {"U", "D"}
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))

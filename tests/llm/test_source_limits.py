import math

from faultline.llm import best_fit


def test_short_documents_of_one_source_fill_their_bins(spark):
    rows = [(i, "one", f"word{i} of three") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    bins = best_fit.packed_windows(best_fit.pack_documents(docs)).collect()
    least = math.ceil(4000 * 3 / best_fit.CAPACITY)
    assert sum(b.n_pieces for b in bins) == 4000
    assert all(b.n_words <= best_fit.CAPACITY for b in bins)
    assert len(bins) <= least + 1


def test_limits_follow_the_shares():
    assert best_fit.source_limits(20480, [10, 400, 0], 2048, 4) == [4, 80, 4]
    sizes, sources = [5] * 6, [0, 0, 0, 1, 1, 1]
    bins = best_fit.pack(sizes, sources, list(range(6)), 100, [1, 3])
    assert bins == [0, 1, 2, 0, 0, 0]

import pyarrow as pa

from clicklake.llm import shingles
from clicklake.llm.common import prepare


def test_batches_of_long_texts_are_bounded(spark):
    prepare(spark)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "bytes"])

    texts = spark.range(0, 5000, 1, 1).selectExpr("repeat('long text ', 400) AS text")
    got = texts.mapInArrow(sizes, "n long, bytes long").collect()
    assert sum(r.n for r in got) == 5000 and max(r.bytes for r in got) < 6_000_000


def test_shingles_leave_no_words_in_the_worker():
    before = {k: len(v) for k, v in vars(shingles).items() if isinstance(v, dict)}
    assert len(shingles.shingle_set(" ".join(f"word{i}" for i in range(3000)))) == 2996
    assert {k: len(v) for k, v in vars(shingles).items() if isinstance(v, dict)} == before

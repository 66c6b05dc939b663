"""The incremental landing lands each file once and applies the batch rules."""

import tempfile

from lakestar import schemas
from lakestar.functions.conform import typed
from lakestar.sources.fixtures import Fixtures
from lakestar.streaming import land_stream
from tests.conftest import SMALL_SF


def test_land_stream_is_incremental(spark):
    base = tempfile.mkdtemp(prefix="lakestar-stream-")
    src, out, ckpt = f"{base}/in", f"{base}/out", f"{base}/ckpt"
    users = Fixtures(spark, SMALL_SF).users.select(schemas.RAW["users"].fieldNames())   # contract order
    opts = dict(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    users.limit(20).write.options(**opts).csv(f"{src}/batch1")
    q = land_stream(spark, f"{src}/*", "users", out, ckpt)
    q.awaitTermination()
    first = spark.read.parquet(out).count()
    assert first == 20
    users.write.options(**opts).csv(f"{src}/batch2")
    q = land_stream(spark, f"{src}/*", "users", out, ckpt)
    q.awaitTermination()
    assert spark.read.parquet(out).count() == 20 + users.count()
    landed = spark.read.parquet(out)
    assert {t for _, t in landed.dtypes} == {"string"}
    landed = typed(landed, schemas.RAW["users"])
    cols = ["user_id", "user_legacy_id", "name", "signup_date"]
    assert sorted(map(tuple, landed.select(cols).distinct().collect()), key=repr) == \
        sorted(map(tuple, users.select(cols).collect()), key=repr)

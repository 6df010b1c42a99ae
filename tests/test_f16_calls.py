"""F16 of the third round, on rows made here."""

import pandas as pd
from pyspark.sql import functions as F

from corpusloom.operators import documents


def test_f16_a_call_gets_few_documents(spark):
    def size(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"id": batch["id"], "n": [len(batch)] * len(batch)})

    found = documents.map_documents(spark.range(3000).coalesce(1), size, "id long, n long")
    assert found.agg(F.max("n"), F.count_distinct("id")).first() == (512, 3000)

"""What operator 5 sends back to the batches of documents."""

import numpy as np
import pyarrow as pa

from lodestone.llm.mixing_lm import _in_place, _returned


def test_place_and_score_share_a_field(spark):
    scores = np.array([-0.0, -745.25, -1e-30, 0.0, -np.inf, -3.0], np.float32)
    places = [5, 0, 2**31 - 1, 1, 4, 3]
    held = spark.createDataFrame([(7, p, bytes([k]), 0, 0) for k, p in enumerate(places)], "batch long, place int, unit binary, blanks int, times long")
    rated = spark.createDataFrame([(bytes([k]), 10 * k, int(b)) for k, b in enumerate(scores.view(np.int32))], "unit binary, c long, log_p_bits int")
    back = _returned(held, rated)
    assert back.dtypes == [("batch", "bigint"), ("placed", "bigint"), ("c", "bigint")]
    c, log_p = _in_place(pa.table(back.toArrow()))
    order = np.argsort(places)
    assert c.tolist() == (10 * order).tolist() and log_p.tobytes() == scores[order].tobytes()

"""Stored frames and their clean-up."""

import os

from riskfeatures.llm.common import forget, shared_folder, stored


def test_stored_frames_are_deleted(spark):
    frame = stored(spark.range(5), "some")
    folder = os.path.dirname(frame.inputFiles()[0].removeprefix("file:").replace("///", "/"))
    assert folder.startswith(shared_folder(spark).removeprefix("file:")) and frame.count() == 5
    forget(frame, None, spark.range(1))  # frames that were not stored are left alone
    assert not os.path.exists(folder)
    forget(frame)

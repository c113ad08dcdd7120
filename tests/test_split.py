from adlake import queries
from adlake.ml import features, training


def test_the_split_is_one_write_of_the_parts(lake):
    found = queries.split_rows(lake)
    parts = features.hash_split(lake.silver, queries.GRAIN, 0.8, training.TRAINING_SEED)
    for mine, part in zip(found, parts, strict=True):
        wanted = features.feature_frame(part, categorical=queries.CATEGORICAL)
        assert mine.columns == wanted.columns and mine.exceptAll(wanted).count() == 0 and mine.count() == wanted.count()
    folders = [{f.rsplit("/", 2)[0] for f in part.inputFiles()} for part in found]
    assert folders[0] == folders[1] and len(folders[0]) == 1

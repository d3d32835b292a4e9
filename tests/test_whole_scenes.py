"""Points of whole scenes, whatever their labels."""

from collections import defaultdict

from waymark.plans import views


class Fixture:
    def __init__(self, df):
        self.df = df

    def path_point(self):
        return self.df


def test_points_of_all_paths_are_put_together(spark):
    paths = {(1, 7): 3, (1, 100): 2, (1, 205): 1, (2, 3): 4, (3, 200): 1}
    rows = [(s, k, i, float(k), float(i)) for (s, k), n in paths.items() for i in range(1, n + 1)]
    df = spark.createDataFrame(rows, "scene long, label long, i long, x double, y double").repartition(3)
    got = defaultdict(list)
    for r in sorted(views.cached_points(Fixture(df)).collect(), key=lambda r: (r.scene, r.position)):
        got[r.scene].append((r.position, r.label, r.i, r.x, r.y))
    want = {s: [(n, *rest) for n, (_, *rest) in enumerate(sorted(r for r in rows if r[0] == s), 1)] for s in (1, 2, 3)}
    assert got == {s: [tuple(x) for x in v] for s, v in want.items()}

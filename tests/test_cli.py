import json

from conftest import SF001
from tessera import cli
from tessera.session import scratch_path
from tessera.sources import bindings as B, files as FS


def test_cli_jobs_end_to_end(spark, capsys):
    rpath = scratch_path(spark, "cli-ratings")
    FS.write_ratings_csv(B.ratings(spark, SF001), rpath)
    cli.main(["usercf", "--filename", rpath, "--k", "20"])
    cli.main(["latent", "--filename", rpath, "--k", "4", "--epochs", "2"])
    out = capsys.readouterr().out
    assert out.count("valid") >= 2 and out.count("test") >= 2
    dpath, ipath = scratch_path(spark, "cli-docs"), scratch_path(spark, "cli-index")
    B.docs(spark, SF001).write.json(dpath)
    cli.main(["index", "--docs", dpath, "--out", ipath])
    cli.main(["search", "--index", ipath, "--q", "ring"])
    env = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert env["num_results"] == len(env["results"]) > 0

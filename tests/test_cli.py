import __spark_entry__ as E
from cardsentry.__main__ import main
from cardsentry.plans import daily


def test_cli_daily_report_tables_sql(spark, tmp_path, capsys):
    root = str(tmp_path / "wh")
    E.write_proxy_drops(spark, "/root/testdata/sf0.001", daily.Layout(root))
    assert main(["daily", "--root", root], spark=spark) == 0
    assert "2024-01-16" in capsys.readouterr().out
    main(["report", "--root", root, "--day", "2024-01-16", "--rows", "5"], spark=spark)
    out = capsys.readouterr().out
    assert "event_type" in out and "passport" in out
    main(["report", "--root", root, "--day", "2024-01-16", "--rule", "overdue_passport"], spark=spark)
    assert "overdue passport" in capsys.readouterr().out
    main(["tables", "--root", root], spark=spark)
    assert {"transactions", "report", "terminals"} <= set(capsys.readouterr().out.split())
    main(["sql", "--root", root, "SELECT count(*) AS n FROM report WHERE event_type = :t",
          "--param", "t=overdue passport"], spark=spark)
    assert "n" in capsys.readouterr().out

"""Sources and sinks: daily text/xlsx drops, the processed-file ledger, proxies."""

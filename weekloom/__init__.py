"""Weekly text-trend analytics on Spark: keyword facts, baselines, spikes, lifecycles, clusters, threads and read views."""

"""Table operators: profile, project, impute, outliers, bin, encode, scale,
split, sample, rebalance, train, evaluate, score."""

"""DataFrame operators: audience, features, target, datasets, ranking, prep, models, evaluation."""

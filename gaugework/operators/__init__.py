"""DataFrame operators: ordering, folds, k-NN, classifiers, metrics, checks."""

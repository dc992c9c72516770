"""DataFrame operators: lookup, aggregate (mean/count, conditional, pivot), best, topk, explode."""

"""Reading and writing datasets, collections and plain files; datasets over the star-schema tables."""

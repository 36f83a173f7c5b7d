"""The data models, each a function of the source mapping returning a lazy DataFrame."""

"""The models of each layer and the reports read from them."""
